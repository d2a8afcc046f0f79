"""Exact k nearest neighbours by cells with boxes (H2).

A bounded sample of rows is cut in two again and again, which gives the cells: of all features and a few cuts of each, the cut is taken that
parts the rows most evenly with the fewest of them near it. Every row belongs to one cell, and a cell knows the smallest and largest value its
rows have in each feature: its box. A query first visits its own cell (the nearest cells that together hold k rows, where that one holds fewer).
The k-th distance found there bounds what it still has to see: of the other cells only those whose box is not farther. No row is nearer than
its box, so neighbours are exact for any data; how many pairs are skipped depends on how far the rows cluster, and
:class:`Neighbors` reports the share that was looked at.

Cells are cut into pieces and their visitors into blocks, both of bounded size, so that a cell with a third of all rows
is many small groups. Inside a group the rows are cut in the same way into leaves with boxes of their own, and a query looks at the leaves that are not farther
than the k-th distance it knows so far. A group hands on k rows a query at most; the best k are kept by a ranked window, which
Spark limits before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.session import written

MAX_CELLS = 1024
SAMPLE_ROWS = 32_768  # from which the cells are cut
PIECE_ROWS = 16_384
BLOCK_QUERIES = 16_384
LEAF_ROWS = 48
PAIRS_AT_ONCE = 1 << 19
SLACK = 1e-9  # relative width added to every bound, far above the rounding of a distance


@dataclass(frozen=True)
class Neighbors:
    rows: DataFrame  # query id, rank from 1, neighbour's id, squared distance, neighbour's label
    visited: float  # pairs of queries and rows of visited cells, as a share of queries times rows


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(rows of a) x (rows of b), summed dimension by dimension: exact where the coordinates are whole numbers."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += np.square(a[:, j, None] - b[None, :, j])
    return out


def box_distances(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(points) x (boxes) squared distances, summed as :func:`squared_distances` does: never above that of a row inside the box, rounding included."""
    out = np.zeros((len(x), len(low)))
    for j in range(x.shape[1]):
        v = x[:, j, None]
        gap = np.maximum(low[None, :, j] - v, v - high[None, :, j])
        np.maximum(gap, 0, out=gap)
        out += np.square(gap, out=gap)
    return out


def _points(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    held = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return held.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1)


def _usable(df: DataFrame, x: str) -> DataFrame:
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return df.where(F.coalesce(F.col(x).isNotNull() & finite, F.lit(False)))


@dataclass(frozen=True)
class Cuts:
    """A tree of cuts: points with at most ``cut`` in ``feature`` go left. A leaf has feature -1, and ``cell`` is its number."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    cell: np.ndarray

    def cells(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows := rows[self.feature[node[rows]] >= 0]):
            at = node[rows]
            node[rows] = self.left[at] + (x[rows, self.feature[at]] > self.cut[at])
        return self.cell[node]


SHARES = (0.5, 0.25, 0.75, 0.125, 0.875)  # of the rows, where a cut is tried


def best_cut(x: np.ndarray, radius: float) -> tuple[int, float] | None:
    """(feature, cut): the bits it tells of a row's side, less those lost by rows within ``radius`` of the other side; None if all rows are the same."""
    n, s = len(x), np.sort(x, axis=0)
    best, found = -math.inf, None
    for share in SHARES:
        low = s[min(int(share * n), n - 1)]  # the cut of each feature is this value, or the one below it where this is the largest
        top = low == s[-1]
        if top.any():
            below = (s < s[-1]).sum(axis=0)
            low = np.where(top, s[np.maximum(below - 1, 0), np.arange(s.shape[1])], low)
        left = (s <= low).sum(axis=0)
        inside = left < n
        high = s[np.minimum(left, n - 1), np.arange(s.shape[1])]
        near = ((s > high - radius) & (s < low + radius)).sum(axis=0) / n if radius else np.zeros(s.shape[1])
        p = np.where(inside, left / n, 0.5)
        bits = np.where(inside, -p * np.log2(p) - (1 - p) * np.log2(1 - p) - np.log2(1 + near), -math.inf)
        wide = np.where(inside, bits + 1e-6 * (s[-1] - s[0]) / max(float((s[-1] - s[0]).max()), 1e-300), -math.inf)  # of equals the wider
        f = int(wide.argmax())
        if wide[f] > best:
            best, found = float(wide[f]), (f, float(low[f]))
    return found if best > -math.inf else None


def cut_cells(x: np.ndarray, cell_rows: int, radius: float) -> tuple[Cuts, list[np.ndarray]]:
    """Cells of about ``cell_rows`` of the points each, and the points of every cell."""
    feature, cut, left, cell, held, todo = [-1], [0.0], [0], [0], [], [(0, np.arange(len(x)))]
    while todo:
        k, rows = todo.pop()
        found = best_cut(x[rows], radius) if len(rows) > cell_rows else None
        if found is None:
            cell[k] = len(held)
            held.append(rows)
            continue
        goes = x[rows, found[0]] > found[1]
        feature[k], cut[k], left[k] = *found, len(feature)
        todo += [(left[k], rows[~goes]), (left[k] + 1, rows[goes])]
        feature += [-1, -1]
        cut += [0.0, 0.0]
        left += [0, 0]
        cell += [0, 0]
    return Cuts(np.array(feature), np.array(cut), np.array(left), np.array(cell, np.int32)), held


def choose_cells(rows: DataFrame, n: int, k: int, most: int = MAX_CELLS) -> Cuts:
    """About sqrt(n) cells, at most about ``most``, cut from a sample of rows by a hash. How near a cut is near: the k-th distance inside the sample."""
    found = rows.orderBy(F.xxhash64("x", "n"), "n").limit(SAMPLE_ROWS).select("x").collect()  # at most SAMPLE_ROWS rows
    x = np.array([r["x"] for r in found], dtype=np.float64)
    some = squared_distances(x[: min(len(x), 64)], x)
    radius = math.sqrt(float(np.median(np.partition(some, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1])))
    return cut_cells(x, max(1, math.ceil(len(x) / max(1, min(most, math.isqrt(n))))), radius)[0]


def first_cells(d2: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """(query, cell) mask: the nearest cells that together hold k rows (all cells, if there are fewer)."""
    order = np.argsort(d2, axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1)
    mask = np.zeros(d2.shape, dtype=bool)
    np.put_along_axis(mask, order, held - sizes[order] < k, axis=1)
    return mask & (sizes > 0)


def reachable_cells(d2: np.ndarray, limit: np.ndarray, near: np.ndarray, far: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """(query, cell) mask: cells that may hold a row no farther than ``limit`` (not squared).

    ``near`` and ``far`` bound the rows' distances from their pivot; ``gaps`` are the distances between pivots.
    """
    d = np.sqrt(d2)
    own = np.argmin(d2, axis=1)
    between = gaps[own]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(between > 0, (d2 - d2[np.arange(len(d2)), own][:, None]) / (2 * between), 0.0)
    bound = np.maximum(np.maximum(d - far, near - d), plane)
    return bound - SLACK * (d + far + between + 1) <= limit[:, None]


def _assign(rows: DataFrame, cuts: Cuts) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cuts.cells(_points(b.column("x"))).astype(np.int32))], names=[*b.schema.names, "cell"])

    return rows.mapInArrow(run, f"{_schema(rows)}, cell int")


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _visits(queries: DataFrame, choose) -> DataFrame:
    """(qn, x, most, cells): ``choose`` maps points and the squared distances that they need not go beyond to (point, cell) numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, cell = choose(_points(b.column("x")), b.column("most").to_numpy(zero_copy_only=False))
            order = np.argsort(q, kind="stable")
            ends = np.searchsorted(q[order], np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(cell[order].astype(np.int32)))], names=["qn", "x", "most", "cells"])

    return queries.select("qn", "x", "most").mapInArrow(run, "qn long, x array<double>, most double, cells array<int>")


def reached(x: np.ndarray, most: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point, box) for all boxes not farther than ``most``. Points of the same cell (``own``) are looked at together: boxes too far from all of them are left out first."""
    order, points, boxes = np.argsort(own, kind="stable"), [], []
    for q in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
        gap = np.maximum(np.maximum(low - x[q].max(axis=0), x[q].min(axis=0) - high), 0)
        far = np.zeros(len(low))
        for j in range(x.shape[1]):
            far += np.square(gap[:, j])
        some = np.flatnonzero(far <= most[q].max())
        for at in range(0, len(q), 256):
            i, j = np.nonzero(box_distances(x[q[at : at + 256]], low[some], high[some]) <= most[q[at : at + 256], None])
            points.append(q[at + i])
            boxes.append(some[j])
    return (np.concatenate(points), np.concatenate(boxes)) if points else (np.empty(0, np.int64), np.empty(0, np.int64))


def _nearest_rows(points: np.ndarray, leaves: list[np.ndarray], asked: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, row, squared distance) of each query's k nearest points not beyond ``most``, ties by the row's number, in this order.

    Products of matrices tell which points may be near enough, with room for their rounding; the distances handed on are summed dimension by dimension.
    """
    low, high = np.stack([points[r].min(axis=0) for r in leaves]), np.stack([points[r].max(axis=0) for r in leaves])
    leaves = [r[:k] if (a == b).all() else r for r, a, b in zip(leaves, low, high)]  # of equal points the first
    middle = points.mean(axis=0)
    centred, out = points - middle, []
    norms = np.square(centred).sum(axis=1)
    step = max(1, min(1024, PAIRS_AT_ONCE // len(leaves), PAIRS_AT_ONCE // max(len(r) for r in leaves)))
    for start in range(0, len(asked), step):
        x, limit = asked[start : start + step], most[start : start + step].copy()
        far, best, found, moved = box_distances(x, low, high), np.full((len(x), k), np.inf), [], x - middle
        own = np.square(moved).sum(axis=1)
        room = 1e-12 * (own + norms.max())
        plain = not np.isfinite(4 * room.max())

        def look(q: np.ndarray, leaf: int) -> None:
            rows = leaves[leaf]
            d2 = squared_distances(x[q], points[rows]) if plain else own[q, None] + norms[rows] - 2 * (moved[q] @ centred[rows].T)
            i, j = np.nonzero(d2 <= (limit if plain else limit + room)[q, None])
            found.append((q[i], rows[j]))
            best[q] = np.partition(np.concatenate([best[q], d2], axis=1), k - 1, axis=1)[:, :k]
            limit[q] = np.minimum(limit[q], best[q].max(axis=1) + (0 if plain else room[q]))

        first = far.argmin(axis=1)
        order = np.argsort(first, kind="stable")
        for q in np.split(order, np.flatnonzero(np.diff(first[order])) + 1):
            q = q[far[q, first[q]] <= limit[q]]
            if len(q):
                look(q, int(first[q[0]]))
        seen = np.zeros(far.shape, dtype=bool)
        seen[np.arange(len(x)), first] = True
        for leaf in np.argsort(far.min(axis=0), kind="stable").tolist():
            q = np.flatnonzero((far[:, leaf] <= limit) & ~seen[:, leaf])
            if len(q):
                look(q, leaf)
        if found:
            q, row = (np.concatenate(parts) for parts in zip(*found))
            d2 = np.zeros(len(q))
            for j in range(x.shape[1]):
                d2 += np.square(x[q, j] - points[row, j])
            kept = d2 <= np.minimum(limit, most[start : start + step])[q]
            q, row, d2 = q[kept], row[kept], d2[kept]
            order = np.lexsort((row, d2, q))
            q, row, d2 = q[order], row[order], d2[order]
            kept = np.arange(len(q)) - np.searchsorted(q, q) < k
            out.append((q[kept] + start, row[kept], d2[kept]))
    return tuple(np.concatenate(parts) for parts in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def _search(cells: DataFrame, visits: DataFrame, sizes: np.ndarray, visitors: np.ndarray, k: int) -> DataFrame:
    """The k nearest rows of every visited piece: (qn, d2, id, n, label)."""
    pieces = F.array(*[F.lit(max(1, -(-int(s) // PIECE_ROWS))) for s in sizes])
    blocks = F.array(*[F.lit(max(1, -(-int(v) // BLOCK_QUERIES))) for v in visitors])
    visited = F.array(*[F.lit(bool(v)) for v in visitors])

    def spread(count):  # 0 .. count - 1
        return F.explode(F.sequence(F.lit(0), count - 1))

    n_pieces, n_blocks = F.get(pieces, F.col("cell")), F.get(blocks, F.col("cell"))
    left = cells.where(F.get(visited, F.col("cell"))).withColumn("piece", F.pmod("n", n_pieces).cast("int")).withColumn("block", spread(n_blocks))
    right = visits.withColumn("cell", F.explode("cells")).withColumn("block", F.pmod("qn", n_blocks).cast("int")).withColumn("piece", spread(n_pieces))
    keys = ["cell", "piece", "block"]
    kind, leaf_rows = cells.schema["id"].dataType.simpleString(), LEAF_ROWS

    def nearest(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table({"qn": pa.array([], pa.int64()), "d2": pa.array([], pa.float64()), "id": pa.array([], rows.schema.field("id").type), "n": pa.array([], pa.int64()), "label": pa.array([], pa.float64())})
        rows = rows.sort_by([("id", "ascending"), ("n", "ascending")])  # nulls last; so that ties go by id
        points, wanted = _points(rows["x"]), _points(asked["x"])
        q, row, d2 = _nearest_rows(points, cut_cells(points, leaf_rows, 0.0)[1], wanted, asked["most"].to_numpy(), k)
        near = rows.select(["id", "n", "label"]).take(pa.array(row))
        return pa.table({"qn": asked["qn"].take(pa.array(q)), "d2": pa.array(d2), "id": near["id"], "n": near["n"], "label": near["label"]})

    left, right = left.select(*keys, "id", "n", "label", "x"), right.select(*keys, "qn", "x", "most")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, f"qn long, d2 double, id {kind}, n long, label double")


def _best(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qn").orderBy("d2", F.col("id").asc_nulls_last(), "n")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbors(train: DataFrame, queries: DataFrame, k: int, x: str = "features", id_col: str = "id", label: str = "label", max_cells: int = MAX_CELLS) -> Neighbors:
    """The k rows of ``train`` nearest to each row of ``queries`` by Euclidean distance, ties by id (null last).

    ``x`` is an array of doubles. Rows whose array is null or holds a null or non-finite entry are neither neighbours nor answered;
    repeated rows count each; with fewer than k rows all are neighbours; an empty table gives no rows.
    """
    rows = _usable(train, x).select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("label"), F.col(x).cast("array<double>").alias("x"))
    asked = _usable(queries, x).select(F.col(id_col).alias("id"), F.col(x).cast("array<double>").alias("x"))
    rows = written(rows.withColumn("n", F.monotonically_increasing_id()), "knn-rows")
    asked = written(asked.withColumn("qn", F.monotonically_increasing_id()), "knn-queries")
    n, n_asked = rows.count(), asked.count()
    kind = rows.schema["id"].dataType.simpleString()
    if not n or not n_asked:
        return Neighbors(train.sparkSession.createDataFrame([], f"query_id {asked.schema['id'].dataType.simpleString()}, rank int, neighbor_id {kind}, d2 double, label double"), 0.0)

    cuts = choose_cells(rows, n, k, max_cells)
    cells = written(_assign(rows, cuts), "knn-cells")
    n_cells, width = int(cuts.cell.max()) + 1, len(rows.first()["x"])
    sizes, low, high = np.zeros(n_cells, dtype=np.int64), np.full((n_cells, width), np.inf), np.full((n_cells, width), -np.inf)
    ends = [f(F.get("x", F.lit(j))).alias(f"{name}{j}") for name, f in (("low", F.min), ("high", F.max)) for j in range(width)]
    for c in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), *ends).collect():  # a row a cell
        sizes[c["cell"]], low[c["cell"]], high[c["cell"]] = c["rows"], c[2 : 2 + width], c[2 + width :]

    def counted(visits: DataFrame) -> np.ndarray:
        out = np.zeros(n_cells, dtype=np.int64)
        for c in visits.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect():  # a row a cell
            out[c["cell"]] = c["count"]
        return out

    def own(x: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = cuts.cells(x)
        few, full = np.flatnonzero(sizes[cell] < k), np.flatnonzero(sizes[cell] >= k)
        parts = [(full, cell[full])]
        for at in range(0, len(few), 256):
            q, c = np.nonzero(first_cells(box_distances(x[few[at : at + 256]], low, high), sizes, k))
            parts.append((few[at + q], c))
        return tuple(np.concatenate(p) for p in zip(*parts))

    def others(x: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q, cell = reached(x, most, cuts.cells(x), low, high)
        new = (sizes[cell] > 0) & ~np.isin(q * n_cells + cell, np.dot((n_cells, 1), np.stack(own(x, most))))
        return q[new], cell[new]

    first = written(_visits(asked.withColumn("most", F.lit(float("inf"))), own), "knn-first")
    first_visitors = counted(first)
    found = written(_best(_search(cells, first, sizes, first_visitors, k), k).drop("rank"), "knn-found")
    limits = written(found.groupBy("qn").agg(F.when(F.count(F.lit(1)) >= k, F.max("d2")).otherwise(F.lit(float("inf"))).alias("most")), "knn-limits")
    rest = written(_visits(asked.join(limits, "qn"), others), "knn-rest")
    rest_visitors = counted(rest)
    best = _best(found.unionByName(_search(cells, rest, sizes, rest_visitors, k)), k)
    pairs = int(((first_visitors + rest_visitors).astype(object) * sizes).sum())
    named = asked.select("qn", F.col("id").alias("query_id")).join(best, "qn")
    return Neighbors(named.select("query_id", "rank", F.col("id").alias("neighbor_id"), "d2", "label"), pairs / (n * n_asked))


def votes(neighbors: DataFrame, k: int) -> DataFrame:
    """(query_id, n, positive, p): of the first k neighbours, how many there are, how many carry label 1, and their share."""
    near = neighbors.where(F.col("rank") <= k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("positive"))
    return near.withColumn("p", F.col("positive") / F.col("n"))
