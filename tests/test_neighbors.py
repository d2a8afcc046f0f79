"""Exact neighbours against brute force: clusters, ties, a hot point, split cells, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.operators import neighbors as N

SCHEMA = "id long, label double, features array<double>"


def _brute(train, asked, k):
    out = {}
    for q, _, x in asked:
        d = sorted((float(sum((a - b) ** 2 for a, b in zip(x, y))), i) for i, _, y in train)
        out[q] = d[:k]
    return out


def _found(result):
    out = {}
    for r in result.rows.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["d2"], r["neighbor_id"]))
    return out


def _rows(seed, n, start=0, hot=0):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-400, 400, (6, 4))
    rows = [(start + i, float(rng.integers(0, 2)), [float(v) for v in centres[rng.integers(0, 6)] + rng.integers(-6, 7, 4)]) for i in range(n)]
    return rows + [(start + n + i, 1.0, [1.0, 2.0, 3.0, 4.0]) for i in range(hot)]


@pytest.mark.parametrize("k", [1, 5, 15])
def test_equal_to_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(N, "PIECE_ROWS", 40)  # so that the hot point's cell is many pieces, and its visitors many blocks
    monkeypatch.setattr(N, "BLOCK_QUERIES", 16)
    train, asked = _rows(1, 400, hot=200), _rows(2, 60, start=10_000, hot=20)
    got = N.nearest_neighbors(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(asked, SCHEMA), k)
    assert _found(got) == _brute(train, asked, k)
    assert got.visited < 0.6


def test_real_coordinates(spark):
    rng = np.random.default_rng(5)
    train = [(i, 0.0, rng.normal(size=3).tolist()) for i in range(500)]
    asked = [(i, 0.0, rng.normal(size=3).tolist()) for i in range(50)]
    got = _found(N.nearest_neighbors(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(asked, SCHEMA), 7))
    want = _brute(train, asked, 7)
    assert {q: [i for _, i in near] for q, near in got.items()} == {q: [i for _, i in near] for q, near in want.items()}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    train = [(1, 1.0, [0.0, 0.0]), (1, 1.0, [0.0, 0.0]), (None, 0.0, [0.0, 0.0]), (2, 0.0, None), (3, 0.0, [nan, 0.0]), (4, 0.0, [None, 0.0]), (5, 0.0, [inf, 0.0])]
    frame = spark.createDataFrame(train, SCHEMA).withColumn("cell", F.lit("x")).withColumn("qn", F.lit(1))
    got = N.nearest_neighbors(frame, frame, 9).rows
    assert {(r["query_id"], r["rank"], r["neighbor_id"]) for r in got.collect()} == {(q, r, i) for q in (1, None) for r, i in ((1, 1), (2, 1), (3, None))}
    assert got.count() == 9
    empty = frame.limit(0)
    assert N.nearest_neighbors(empty, frame, 3).rows.count() == 0
    assert N.nearest_neighbors(frame, empty, 3).rows.count() == 0


def test_votes(spark):
    near = spark.createDataFrame([(1, 1, 7, 0.0, 1.0), (1, 2, 8, 0.0, 0.0), (1, 3, 9, 0.0, 0.0)], "query_id long, rank int, neighbor_id long, d2 double, label double")
    assert [tuple(r) for r in N.votes(near, 2).collect()] == [(1, 2, 1, 0.5)]


def test_bounds_never_close_a_cell_that_holds_a_neighbour():
    rng = np.random.default_rng(3)
    rows, pivots, asked = rng.normal(size=(300, 5)), rng.normal(size=(12, 5)), rng.normal(size=(40, 5))
    d2 = N.squared_distances(rows, pivots)
    cell, r = d2.argmin(1), np.sqrt(d2.min(1))
    near = np.array([r[cell == c].min(initial=np.inf) for c in range(12)])
    far = np.array([r[cell == c].max(initial=0) for c in range(12)])
    dist = np.sqrt(N.squared_distances(asked, rows))
    limit = np.sort(dist, axis=1)[:, 4]
    opened = N.reachable_cells(N.squared_distances(asked, pivots), limit, np.where(np.isinf(near), 0, near), far, np.sqrt(N.squared_distances(pivots, pivots)))
    for q, t in np.argwhere(dist <= limit[:, None]):
        assert opened[q, cell[t]]
    assert not opened.all()


def test_cells_leave_out_most_pairs_of_points_with_categories(spark):
    rng = np.random.default_rng(8)

    def rows(n, start):
        kinds = rng.integers(0, 2, (n, 8)) * 700.0
        return [(start + i, float(i % 2), [float(v) for v in np.concatenate([np.round(rng.normal(0, 300, 3)), kinds[i]])]) for i in range(n)]

    train, asked = rows(3000, 0), rows(60, 10_000)
    got = N.nearest_neighbors(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(asked, SCHEMA), 3)
    assert _found(got) == _brute(train, asked, 3)
    assert got.visited < 0.1


def test_nearest_rows_far_from_the_origin_and_repeated():
    rng = np.random.default_rng(9)
    for shift, scale in ((3e9, 1.0), (0.0, 1e-9), (0.0, 1e160)):
        points = np.round(rng.normal(size=(600, 3)) * 4) * scale + shift
        asked, most = points[::9] + 0.5 * scale, np.where(np.arange(67) % 2, np.inf, 9.0 * scale * scale)
        with np.errstate(over="ignore"):
            d2 = N.squared_distances(asked, points)
            q, row, found = N._nearest_rows(points, N.cut_cells(points, 20, 0.0)[1], asked, most, 5)
        want = [(i, t, d2[i, t]) for i in range(len(asked)) for t in np.lexsort((np.arange(600), d2[i]))[:5] if d2[i, t] <= most[i]]
        assert list(zip(q.tolist(), row.tolist(), found.tolist())) == want
