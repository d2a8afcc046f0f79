"""Ranked lexical search as exact inner-product search over sparse ball trees.

A document is a sparse vector of whole-number impacts of its terms, an item the vector of its terms' weights; a document's score
is their inner product. Only coordinates of terms that some item holds can matter, so documents keep just
those. Each task cuts its documents into blocks and builds a tree over each: a node's documents are split in halves along the
line on which they spread most. With coordinates multiplied by the terms' weights, an item becomes a 0/1 vector q, and

    q.x = q.c + q.(x - c) <= q.c + sum over g of |q_g| * r_g

for every x of a node with centroid c, where g runs over subspaces (groups of coordinates) and r_g is the node's radius in one. One radius
a subspace keeps the rare terms of other items out of an item's bound. Per item the subtree with the highest bound is opened first, and
the search of a block ends when that bound is below the k-th best score so far. Leaves are scored exactly in 64-bit integers.

Safe rounding: centroids, radii and bounds are doubles, whose errors here are below 1e-11 of the numbers added; squared radii
are raised by 4e-12 of the squares they come from, and bounds by 1e-9 of themselves and 1. A bound that equals the k-th score is still
opened, as ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.common import stage, text_batches

ITEMS_AT_ONCE = 256  # searched for in one pass over the documents; more items take more passes
BLOCK_DOCS, BLOCK_ENTRIES, LEAF_DOCS = 8192, 2_000_000, 64
SUBSPACES, POWER_STEPS = 512, 3

#: ASCII letters and digits and all bytes beyond ASCII make terms; only A-Z are lower-cased.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, with repeats: maximal runs of what is neither ASCII punctuation, space nor control."""
    return (text or "").encode().translate(TERM_BYTES).split()


# ----------------------------------------------------------------------------- one block of documents


@dataclass
class Queries:
    """The items of one pass: ``weights[q, t]`` is the weight of term t in item q (0: not in it)."""

    weights: np.ndarray
    scale: np.ndarray = field(init=False)  # a term's weight
    group: np.ndarray = field(init=False)  # a term's subspace
    members: np.ndarray = field(init=False)  # 0/1, terms x items
    sizes: np.ndarray = field(init=False)  # square root of an item's terms in each subspace, subspaces x items

    def __post_init__(self) -> None:
        held = self.weights > 0
        self.scale = self.weights.max(axis=0, initial=0).astype(float)
        shared = np.argsort(-held.sum(axis=0), kind="stable")
        own = SUBSPACES // 2
        # The terms that most items share have a subspace each; others go with the first item that holds them.
        self.group = own + (held.argmax(axis=0) if len(held) else np.zeros(held.shape[1], int)) % own
        self.group[shared[:own]] = np.arange(len(shared[:own]))
        self.members = held.T.astype(float)
        counts = np.zeros((SUBSPACES, len(held)))
        np.add.at(counts, self.group, self.members)
        self.sizes = np.sqrt(counts)


class BallTree:
    """Documents as (starts, terms, impacts) in rows; nodes are runs of the tree's document order, children of k are 2k+1 and 2k+2."""

    def __init__(self, starts: np.ndarray, term: np.ndarray, impact: np.ndarray, queries: Queries):
        self.queries, n = queries, len(starts) - 1
        dims, scaled = queries.weights.shape[1], impact * queries.scale[term]
        lengths = np.diff(starts)
        order = np.arange(n)
        self.runs: list[tuple[int, int]] = []
        centroids, radii = [], []
        runs = [(0, n)]
        group_key = queries.group
        while runs:
            self.runs += runs
            cuts = np.array([a for a, _ in runs])
            of_place = np.repeat(np.arange(len(runs)), [b - a for a, b in runs])
            node = np.empty(n, np.int64)
            node[order] = of_place
            at = np.repeat(node, lengths) * dims + term  # where an entry falls in a (nodes x terms) table
            doc = np.repeat(np.arange(n), lengths)
            c = np.bincount(at, weights=scaled, minlength=len(runs) * dims) / np.bincount(node, minlength=len(runs)).repeat(dims)
            table = c.reshape(len(runs), dims)
            centroids.append(table)
            mine = c[at]
            squares = np.zeros((len(runs), SUBSPACES))
            np.add.at(squares.T, group_key, (table * table).T)
            cell = doc * SUBSPACES + group_key[term]
            gap = np.bincount(cell, weights=(scaled - mine) ** 2 - mine**2, minlength=n * SUBSPACES).reshape(n, SUBSPACES) + squares[node]
            size = np.bincount(cell, weights=scaled**2, minlength=n * SUBSPACES).reshape(n, SUBSPACES) + squares[node]
            radii.append(np.sqrt(np.maximum.reduceat((np.maximum(gap, 0) + 4e-12 * size)[order], cuts, axis=0)))
            if runs[0][1] - runs[0][0] <= LEAF_DOCS:
                break
            # The line along which a node's documents spread most: power iteration from the document farthest from the centroid.
            line = self._rows(self._farthest(gap.sum(axis=1)[order], cuts, order), starts, term, scaled, dims) - c
            for turn in range(POWER_STEPS + 1):
                along = np.bincount(doc, weights=scaled * line[at], minlength=n)
                along -= (np.bincount(node, weights=along) / np.bincount(node))[node]
                if turn < POWER_STEPS:
                    line = np.bincount(at, weights=scaled * along[doc], minlength=len(line))
                    line /= np.maximum(np.abs(line).reshape(len(runs), dims).max(axis=1), 1e-300).repeat(dims)
            order = order[np.lexsort((order, along[order], of_place))]
            runs = [half for a, b in runs for half in ((a, (a + b + 1) // 2), ((a + b + 1) // 2, b))]
        self.first_leaf = len(self.runs) - len(runs)
        self.order = order
        pick = np.repeat(starts[:-1][order], lengths[order]) + np.arange(len(term)) - np.repeat(np.concatenate([[0], np.cumsum(lengths[order])[:-1]]), lengths[order])
        self.starts = np.concatenate([[0], np.cumsum(lengths[order])])
        self.term, self.impact = term[pick], impact[pick]
        self.bounds = (np.vstack(centroids) @ queries.members + np.vstack(radii) @ queries.sizes) * (1 + 1e-9) + 1

    @staticmethod
    def _farthest(distance: np.ndarray, cuts: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The document of each run with the largest distance (in document order)."""
        best = np.maximum.reduceat(distance, cuts)
        ends = np.append(cuts[1:], len(distance))
        hit = np.flatnonzero(distance == np.repeat(best, ends - cuts))
        return order[hit[np.searchsorted(hit, cuts)]]

    @staticmethod
    def _rows(docs: np.ndarray, starts: np.ndarray, term: np.ndarray, scaled: np.ndarray, dims: int) -> np.ndarray:
        """The documents' vectors, one row a node, as a flat table."""
        out = np.zeros(len(docs) * dims)
        for k, d in enumerate(docs):
            out[k * dims + term[starts[d] : starts[d + 1]]] = scaled[starts[d] : starts[d + 1]]
        return out

    def leaf_scores(self, k: int, q: int) -> np.ndarray:
        """Exact scores of a leaf's documents."""
        a, b = self.runs[k]
        low, high = self.starts[a], self.starts[b]
        return np.add.reduceat(self.queries.weights[q][self.term[low:high]] * self.impact[low:high], self.starts[a:b] - low)


class Best:
    """The k best of one item so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: list[int], ids: list) -> None:
        self.rows += [(-s, i is None, i if i is not None else 0, i) for s, i in zip(scores, ids)]
        self.rows.sort(key=lambda r: r[:3])
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = max(1, -self.rows[-1][0])


def search_block(tree: BallTree, ids: list, best: list[Best]) -> int:
    """Update each item's best with a block's documents, best subtree first; returns the number of leaves scored."""
    scored = 0
    for q, found in enumerate(best):
        bound = tree.bounds[:, q]
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= found.least:
            _, k = heapq.heappop(heap)
            if k < tree.first_leaf:
                for child in (2 * k + 1, 2 * k + 2):
                    if bound[child] >= found.least:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            scored += 1
            scores = tree.leaf_scores(k, q)
            hits = np.flatnonzero(scores >= found.least)
            if len(hits):
                a = tree.runs[k][0]
                found.add(scores[hits].tolist(), [ids[tree.order[a + h]] for h in hits])
    return scored


def lengths_in_tenths(n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """m of each document: 10 + (90 n N) div L, in exact integers."""
    if int(n.max(initial=0)) * 90 * docs < 2**63:
        return 10 + (90 * n * docs) // words
    return np.array([10 + 90 * x * docs // words for x in n.tolist()], np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def term_weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# ----------------------------------------------------------------------------- on Spark


def _lists(flat: list, counts: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat, pa.int32()))


def _counted(vocabulary: dict[bytes, int]):
    """id, n, and the item terms a document holds with how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for b in batches:
            n, held, often, sizes = [], [], [], []
            for text in b.column(1).to_pylist():
                words = terms(text)
                known = np.array([t for t in map(get, words) if t is not None], np.int32)
                t, tf = np.unique(known, return_counts=True)
                n.append(len(words))
                held.append(t)
                often.append(tf)
                sizes.append(len(t))
            flat = lambda parts: np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), _lists(flat(held), sizes), _lists(flat(often), sizes)], names=["id", "n", "terms", "tf"])

    return run


def _searched(sent, docs: int, words: int, k: int):
    """(q, id, score): the k best of a task's documents for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(sent.value)
        best = [Best(k) for _ in range(len(queries.weights))]
        kind, held, entries = None, [], 0

        def search() -> None:
            ids = [i for b in held for i in b[0]]
            n, lengths, term, tf = (np.concatenate([b[c] for b in held]) for c in range(1, 5))
            impact = impacts(tf, np.repeat(lengths_in_tenths(n, docs, words), lengths))
            search_block(BallTree(np.concatenate([[0], np.cumsum(lengths)]), term, impact, queries), ids, best)

        for whole in batches:
            kind = whole.schema.field(0).type
            for b in (whole.slice(at, 512) for at in range(0, whole.num_rows, 512)):
                lengths = b.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                if held and (sum(len(x[0]) for x in held) + len(lengths) > BLOCK_DOCS or entries + lengths.sum() > BLOCK_ENTRIES):
                    search()
                    held, entries = [], 0
                held.append((b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False), lengths, *(b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))))
                entries += int(lengths.sum())
        if held:
            search()
        rows = [(q, r[3], -r[0]) for q, found in enumerate(best) for r in found.rows]
        if rows:
            q, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, kind), pa.array(scores, pa.int64())], names=["q", "id", "score"])

    return run


def _one_pass(texts: DataFrame, items: list[tuple], k: int, item_type: str) -> DataFrame:
    """q, id, score and item of the k best documents of each item; ``items`` are (item id, text)."""
    spark = texts.sparkSession
    wanted = [set(terms(text)) for _, text in items]
    vocabulary = {t: j for j, t in enumerate(sorted(set().union(*wanted)))}
    kind = texts.schema["id"].dataType.simpleString()
    counted = stage(texts.mapInArrow(_counted(vocabulary), f"id {kind}, n long, terms array<int>, tf array<int>"), "term-counts")
    size = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("words")).first()
    docs, words = size["docs"], size["words"] or 0
    df = dict.fromkeys(vocabulary.values(), 0)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():  # at most the items' terms
        df[r["t"]] = r["n"]
    weights = np.zeros((len(items), len(vocabulary)), np.int64)
    for q, held in enumerate(wanted):
        for t in held:
            if df[vocabulary[t]]:
                weights[q, vocabulary[t]] = term_weight(docs, df[vocabulary[t]])
    sent = spark.sparkContext.broadcast(weights)  # at most ITEMS_AT_ONCE rows
    near = counted.where(F.size("terms") > 0).mapInArrow(_searched(sent, docs, max(1, words), k), f"q int, id {kind}, score long")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    ranked = near.withColumn("rank", place).where(F.col("rank") <= k)
    named = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(items)], f"q int, item {item_type}")
    return ranked.join(F.broadcast(named), "q")


def search(documents: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """item id, rank (int, from 1), document id, score (long): each item's ``k`` documents with the highest scores above 0.

    Every row of ``documents`` counts, rows that repeat too; equal scores come by ascending id, null ids last. Null and empty texts
    have no terms: such documents are not counted and never found, such items find nothing. Rows of ``items`` that
    repeat id and text are one item; rows that share an id but not the text are ranked each for itself. Other columns are not read.
    Items are taken ``items_at_once`` (about) at a time; each time all documents are read.
    """
    spark = documents.sparkSession
    text_batches(spark)
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where(F.col("text").isNotNull()).distinct()
    asked = stage(asked, "items")
    passes = max(1, -(-asked.count() // items_at_once))
    item_type = items.schema[item_col].dataType.simpleString()
    out = None
    for p in range(passes):
        share: Column = F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == p
        rows = sorted(((r["item"], r["text"]) for r in asked.where(share).collect()), key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
        found = _one_pass(texts, rows, k, item_type) if rows else None
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        kind = texts.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"`{item_col}` {item_type}, rank int, `{id_col}` {kind}, score long")
    return out.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
