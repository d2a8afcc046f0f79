"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint position i gets the code c(i) = 1 + i mod 15, a non-zero vector of four bits. Table v
(1..15) keeps the positions whose code has an odd number of bits in common with v, 32 to 34 of the 64. Three differing
positions have three codes, which cannot span the four-dimensional space, so some non-zero v is
orthogonal to all three, and the pair agrees on everything that table v keeps. Every pair within
three bits therefore meets in at least one of the 15 tables: there are no false negatives.

Equal fingerprints are merged first. A bucket of at most ``bucket_cap`` different fingerprints is
compared in one task, which emits a spanning forest of its links, not its pairs. In a larger
bucket the members can differ only in the positions that its table leaves out, so each emits
its variants (one side with up to two flips, the other with one), and those that
share a variant are chained: linear in the bucket's size, exact, and with groups bounded by the
number of variants. Components are found by star contraction on tables, nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import long_literal, stage, text_batches, utf8

RADIUS = 3
SEED = 42
CODES = [1 + i % 15 for i in range(64)]
MASKS = {v: sum(1 << i for i, c in enumerate(CODES) if (c & v).bit_count() % 2) for v in range(1, 16)}


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text in UTF-8; zero for a text without words."""
    words = data.lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n < 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 8192):
        ones += np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long; null text has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x, shingle) for x in utf8(b.column(1))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["id", "fp"])

    text_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def bucket_links(members: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links between different fingerprints of one bucket."""
    rest, links = members.astype(np.int64), []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), dtype=bool)
            source = np.zeros(len(rest), dtype=np.int64)
            for x in front:
                hit = ~near & (np.bitwise_count((rest ^ x).view(np.uint64)) <= radius)
                source[hit] = x
                near |= hit
            links.extend(zip(source[near].tolist(), rest[near].tolist()))
            front, rest = rest[near], rest[~near]
    return links


def _bucket_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        links = [x for m in b.column(0).to_pylist() for x in bucket_links(np.array(m, dtype=np.int64))]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])


def variants(v: int) -> list[int]:
    """The flips of up to two of the positions that table v leaves out; one side's two and the other's one make three."""
    free = [i for i in range(64) if not MASKS[v] >> i & 1]
    return [0, *(1 << i for i in free), *(1 << i | 1 << j for i, j in combinations(free, 2))]


def links(fps: DataFrame, bucket_cap: int = 8192) -> DataFrame:
    """(a, b): links between different fingerprints, enough to connect all that are within three bits."""
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(long_literal(m)).alias("key")) for v, m in MASKS.items()])
    keyed = fps.select("fp", F.inline(tables))
    sizes = stage(keyed.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    small = keyed.join(sizes.where(F.col("n") <= bucket_cap).drop("n"), ["v", "key"])
    found = small.groupBy("v", "key").agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(_bucket_task, "a long, b long")
    large = sizes.where(F.col("n") > bucket_cap).drop("n")
    if large.isEmpty():
        return found
    return found.unionAll(_variant_links(keyed.join(large, ["v", "key"])))


def _variant_links(crowded: DataFrame) -> DataFrame:
    """Links inside crowded buckets: a pair within three bits has f ^ e = g ^ d with |e| <= 2 and |d| <= 1.

    All that emit a variant without a flip or with one are within two bits of each other, so they
    are chained to the smallest of them; whoever emits it with two flips is checked against each of these, at most 31.
    """
    flips = F.create_map(*[x for v in MASKS for x in (F.lit(v), F.array(*[long_literal(e) for e in variants(v)]))])
    out = crowded.select("fp", "v", F.explode(F.element_at(flips, F.col("v"))).alias("e"))
    out = out.select("fp", F.col("fp").bitwiseXOR(F.col("e")).alias("variant"), "v", (F.bit_count("e") == 2).alias("far"))
    near = stage(out.where("not far").groupBy("v", "variant").agg(F.collect_set("fp").alias("near")), "near")
    chained = near.where(F.size("near") > 1).select(F.array_min("near").alias("a"), F.explode("near").alias("b")).where("a <> b")
    met = out.where("far").join(near, ["v", "variant"]).select("fp", F.explode("near").alias("b"))
    met = met.where((F.col("fp") != F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= RADIUS))
    return chained.unionAll(met.select(F.col("fp").alias("a"), "b"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of star contraction over (u, v): every node hands its neighbours to the smallest of them.

    large: only to neighbours above the node; else edges run from the larger node to the smaller.
    The minimum is written before the join, so that a node with very many neighbours can be split.
    """
    if large:
        edges = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        return edges.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every linked node and the smallest node of its component (which has no row of its own).

    Alternates large and small star steps (Kiveris et al., 2014) until the edges stay the same;
    the number of rounds grows with the logarithm of the component's size.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stage(edges, "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            return edges
        before = state
        edges = stage(_star(stage(_star(edges, True), "large"), False), "small")


def _rooted(rows: DataFrame, bucket_cap: int) -> DataFrame:
    """(fp, least, root): every different fingerprint of ``rows``, its smallest id and the smallest fingerprint of its component."""
    fps = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    member = components(links(fps.select("fp"), bucket_cap))
    member = member.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = fps.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return stage(rooted, "rooted")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bucket_cap: int = 8192) -> DataFrame:
    """One row per input row: id, fp (signed long), component_id (smallest id reachable over links).

    Null and empty texts have fingerprint zero and are linked like any other. Null ids count
    for links but are never a component's id (a component of null ids only has a null one).
    Repeated rows are in one component. Other columns are not read. An empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    rooted = _rooted(rows, bucket_cap)
    ids = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    ids = stage(rooted.join(ids, "root").select("fp", "component_id"), "labels")
    return rows.join(ids, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row of ``docs`` per component, all columns: that of the smallest (id, fingerprint, text digest), null ids last.

    Rows are told apart by id and text digest, so repeated and null ids are decided row by row; of rows equal in both one stays.
    """
    digest = F.xxhash64(F.col(text_col))
    keys = docs.select(F.struct(F.col(id_col).alias("id"), digest.alias("digest")).alias("key"), F.col(text_col).alias("text"))
    found = fingerprints(keys, "key", "text", shingle).select(F.col("id.id").alias("id"), F.col("id.digest").alias("digest"), "fp")
    rows = stage(found.groupBy("id", "digest", "fp").agg(F.count(F.lit(1)).alias("n")), "fingerprints")
    rows = rows.join(_rooted(rows, 8192).select("fp", "root"), "fp")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "fp", "digest")
    first = stage(rows.groupBy("root").agg(F.min(place).alias("first"), F.sum("n").alias("size")).where("size > 1"), "first")
    crowd = stage(rows.join(first, "root").select("id", "digest", "n", (place == F.col("first")).alias("stays")), "crowd")

    def same(other: DataFrame) -> Column:
        return F.col(id_col).eqNullSafe(other["_sh_id"]) & (digest == other["_sh_digest"])

    named = crowd.select(F.col("id").alias("_sh_id"), F.col("digest").alias("_sh_digest"), "n", "stays")
    gone = named.where("not stays or n > 1").select("_sh_id", "_sh_digest")
    left = docs.join(gone, same(gone), "left_anti")
    again = named.where("stays and n > 1").select("_sh_id", "_sh_digest")  # rows equal in id and text: one of them stays
    if again.isEmpty():
        return left
    repeated = docs.join(again, same(again)).dropDuplicates(["_sh_id", "_sh_digest"])
    return left.unionAll(repeated.select(*docs.columns))
