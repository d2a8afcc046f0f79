"""Embedding whitening by a bidiagonal qd solver.

The singular values and right singular vectors of the centred rows are found without forming a covariance:

1. Blockwise QR reduces the centred rows to one triangle R: each task keeps a running triangle of its blocks, triangles are
   reduced in groups until one is left (dimension x dimension).
2. Householder reflections make R bidiagonal, R = U B W'.
3. dqds, the differential qd algorithm with shifts, finds the squared singular values of B to high relative
   accuracy: a transform only multiplies, divides and adds positive numbers, and a shift that goes too far is taken back.
4. Twisted factorisations of B'B - e I give each direction: the stationary transform from the top and the progressive one from
   the bottom meet at the place with the smallest remainder. Directions of close values are made orthogonal as they are found.

Components are W times those directions; e / n is the variance along one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import stage

EPS = np.finfo(float).eps
LARGEST = 2.0**40  # of an entry times 64; beyond it a whole number plus the offset is not exact enough to work with
FAN_IN = 16  # triangles reduced by one task


# ----------------------------------------------------------------------------- the small problem


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B and the orthogonal W of R = U B W', by Householder reflections from both sides."""
    a, n = np.array(r, float), r.shape[1]
    w = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        norm = np.linalg.norm(x)
        if norm == 0:
            return x, 0.0
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        return v / np.linalg.norm(v), 2.0

    for k in range(n):
        v, f = reflector(a[k:, k])
        a[k:, k:] -= f * np.outer(v, v @ a[k:, k:])
        if k + 2 <= n:
            v, f = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= f * np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= f * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One transform of the qd array less ``shift``; None if the shift exceeds the smallest value. Also the smallest remainder."""
    n, d = len(q), q[0] - shift
    least, nq, ne = d, [0.0] * len(q), [0.0] * len(e)
    for k in range(n - 1):
        if d < 0:
            return None
        nq[k] = d + e[k]
        if nq[k] == 0:
            ne[k], d = 0.0, q[k + 1] - shift
        else:
            t = q[k + 1] / nq[k]
            ne[k], d = e[k] * t, d * t - shift
        least = min(least, d)
    if not d >= 0:
        return None
    nq[n - 1] = d
    return nq, ne, least


def _safe_shift(q: list[float], e: list[float]) -> float:
    """A bound below the smallest value: 1 over the trace of the inverse, from sums of positive terms."""
    trace, row = 0.0, 0.0
    for k, x in enumerate(q):
        if x <= 0:
            return 0.0
        row = (1 + (e[k - 1] * row if k else 0.0)) / x
        trace += row
    return (1 - 1e-10) / trace if np.isfinite(trace) else 0.0


def dqds(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    found: list[float] = []
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in superdiagonal], 0.0)]
    while todo:
        q, e, taken = todo.pop()
        guess = 0.0
        while q:
            n = len(q)
            small = [k for k in range(n - 1) if e[k] <= EPS * EPS * (taken + q[k]) or e[k] <= EPS * EPS * q[k + 1]]
            if small:  # the array falls apart
                k = small[-1]
                if k < n - 2:
                    todo.append((q[k + 1 :], e[k + 1 :], taken))
                else:
                    found.append(taken + q[-1])
                q, e = q[: k + 1], e[:k]
                continue
            if n == 1:
                found.append(taken + q[0])
                break
            step = None
            for shift in (guess, 0.75 * guess, _safe_shift(q, e)):
                if shift > 0 and (step := _dqds_step(q, e, shift)):
                    break
            if step is None:
                shift, step = 0.0, _dqds_step(q, e, 0.0)
            taken += shift
            q, e, least = step
            # The last remainder is near the smallest value once the last coupling is small; it is tried less that coupling.
            guess = max(0.0, least - 2 * e[-1]) if least == q[-1] else 0.25 * max(0.0, least)
    return np.sort(np.array(found))[::-1]


def _twisted(q: np.ndarray, e: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers of the stationary transform of B'B - value I from the top, of the progressive one from the bottom, and the
    remainder where they meet. B'B is L D L' with D = q and L holding e, so that T[k, k+1] = sqrt(q e)."""
    n = len(q)
    tiny = EPS * max(float(np.max(q)), np.finfo(float).tiny / EPS)
    low, high, meet = np.zeros(n - 1), np.zeros(n - 1), np.zeros(n)
    off = np.sqrt(q[:-1] * e)
    s, s_all = -value, np.zeros(n)
    for k in range(n - 1):
        s_all[k] = s
        d = s + q[k]
        d = d if abs(d) > tiny else np.copysign(tiny, d)
        low[k] = off[k] / d
        s = e[k] * s / d - value
    s_all[n - 1] = s
    p, p_all = q[n - 1] - value, np.zeros(n)
    for k in range(n - 2, -1, -1):
        p_all[k + 1] = p
        d = e[k] + p
        d = d if abs(d) > tiny else np.copysign(tiny, d)
        high[k] = off[k] / d
        p = p * q[k] / d - value
    p_all[0] = p
    meet = s_all + p_all + value
    return low, high, meet


def _solve(low: np.ndarray, high: np.ndarray, at: int) -> np.ndarray:
    """The vector that the twisted factorisation sends to a multiple of unit vector ``at``."""
    z = np.zeros(len(low) + 1)
    z[at] = 1.0
    for k in range(at - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(at, len(low)):
        z[k + 1] = -high[k] * z[k]
    return z / np.linalg.norm(z)


def directions(diagonal: np.ndarray, superdiagonal: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Unit eigenvectors of B'B for the ``count`` largest values, as columns.

    A vector is the twisted solution at its smallest remainder. Where values are close, the meeting place whose solution is
    most independent of the cluster's earlier ones is taken, and the part along those is removed twice.
    """
    q, e = diagonal**2, superdiagonal**2
    sign = np.cumprod(np.concatenate([[1.0], np.where(diagonal[:-1] * superdiagonal < 0, -1.0, 1.0)])) if len(q) > 1 else np.ones(1)
    n, out = len(q), []
    cluster = 0  # where the present run of close values began
    for j in range(count):
        if j and values[j - 1] - values[j] > 1e-3 * values[j - 1]:
            cluster = j
        if n == 1:
            out.append(np.ones(1))
            continue
        low, high, meet = _twisted(q, e, float(values[j]))
        earlier = np.array(out[cluster:j]).T if j > cluster else None
        places = np.argsort(np.abs(meet), kind="stable")
        best, left = None, 0.0
        for at in places if earlier is not None else places[:1]:
            z = _solve(low, high, int(at))
            if not np.all(np.isfinite(z)):
                continue
            if earlier is not None:
                for _ in range(2):
                    z = z - earlier @ (earlier.T @ z)
            size = float(np.linalg.norm(z))
            if size > left:
                best, left = z / max(size, np.finfo(float).tiny), size
            if left > 0.1:
                break
        out.append(best)
    return np.array(out).T * sign[:, None]


def principal(r: np.ndarray, n: int, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Variances (falling) and unit directions (columns) of the ``count`` largest components with a variance above rounding, and the total."""
    diagonal, superdiagonal, w = bidiagonalise(r)
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(superdiagonal).max(initial=0.0))
    if not scale > 0:
        return np.zeros(0), np.zeros((len(r), 0)), 0.0
    diagonal, superdiagonal = diagonal / scale, superdiagonal / scale
    values = dqds(diagonal, superdiagonal)
    count = min(count, int((values > (len(values) * EPS) ** 2 * values[0]).sum()))
    z = directions(diagonal, superdiagonal, values, count)
    vectors = w @ z
    # One Rayleigh-Ritz step inside runs of close values, where single directions are only fixed up to a rotation.
    vectors, _ = np.linalg.qr(vectors)
    image = r @ vectors / scale
    begin = 0
    for j in range(1, count + 1):
        if j == count or values[j - 1] - values[j] > 1e-3 * values[j - 1]:
            if j - begin > 1:
                _, _, turn = np.linalg.svd(image[:, begin:j], full_matrices=False)
                vectors[:, begin:j] = vectors[:, begin:j] @ turn.T
            begin = j
    return values[:count] * scale**2 / n, vectors, float(values.sum() * scale**2 / n)


# ----------------------------------------------------------------------------- on Spark


def whole_entries(vectors: list[np.ndarray]) -> np.ndarray:
    """x = floor(64 c) + 1000000 of every entry, as longs."""
    return np.floor(64.0 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, x of the rows whose vector is not null or empty and holds only finite entries, with x the whole entries."""
    entry = F.col(vector_col)
    fine = F.forall(entry, lambda c: F.coalesce(F.abs(c.cast("double") * 64) < LARGEST, F.lit(False)) & ~F.coalesce(F.isnan(c.cast("double")), F.lit(True)))
    rows = df.where(entry.isNotNull() & (F.size(entry) > 0) & fine)
    return rows.select(F.col(id_col).alias("id"), F.transform(entry, lambda c: F.floor(c.cast("double") * 64).cast("long") + F.lit(1_000_000).cast("long")).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, np.int64)
        for b in batches:
            total += _matrix(b.column(0), d).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total)], names=["dim", "s"])

    return run


def _centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - S / n; the whole part of the mean is taken off exactly first."""
    whole = s // n
    return (x - whole) - (s - whole * n) / n


def _triangle(n: int, s: np.ndarray):
    """A task's triangle: QR of the running one on top of each block of centred rows."""
    d = len(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for b in batches:
            r = np.linalg.qr(np.vstack([r, _centred(_matrix(b.column(0), d), n, s)]), mode="r")
        if len(r):
            yield _packed(r)

    return run


def _packed(r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["r"])


def _stacked(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for b in batches:
            for one in b.column(0).to_pylist():
                r = np.linalg.qr(np.vstack([r, np.frombuffer(one).reshape(-1, d)]), mode="r")
        if len(r):
            yield _packed(r)

    return run


def reduce_rows(rows: DataFrame, n: int, s: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of all centred rows, d x d; only R reaches the driver."""
    d = len(s)
    triangles = stage(rows.select("x").mapInArrow(_triangle(n, s), "r binary"), "triangles")
    while (left := triangles.count()) > FAN_IN:
        triangles = stage(triangles.repartition(-(-left // FAN_IN)).mapInArrow(_stacked(d), "r binary"), "triangles")
    r = np.zeros((0, d))
    for row in triangles.collect():  # at most FAN_IN triangles
        r = np.linalg.qr(np.vstack([r, np.frombuffer(bytes(row["r"])).reshape(-1, d)]), mode="r")
    return np.vstack([r, np.zeros((d - len(r), d))])


def _projected(x: np.ndarray, n: int, s: np.ndarray, e: np.ndarray, v: np.ndarray) -> np.ndarray:
    return _centred(x, n, s) @ v / np.sqrt(e)


def _moments(n: int, s: np.ndarray, e: np.ndarray, v: np.ndarray):
    """(row, column, sum of products, ...) of a task's whitened rows, with plain sums in row -1."""
    k = len(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            w = _projected(_matrix(b.column(0), len(s)), n, s, e, v)
            products += w.T @ w
            sums += w.sum(axis=0)
        i, j = np.indices((k, k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i.ravel(), np.full(k, -1)]), pa.int32()), pa.array(np.concatenate([j.ravel(), np.arange(k)]), pa.int32()), pa.array(np.concatenate([products.ravel(), sums]))], names=["i", "j", "m"]
        )

    return run


def _deviation(x: np.ndarray, n: int, s: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exact; null where it does not fit a long."""
    whole = s // n
    rest = s - whole * n
    part = x - whole  # n x - S = n part - rest
    biggest = int(np.abs(part).max(initial=0) + 1) * n
    if biggest * biggest * x.shape[1] < 2**63:
        gap = part * n - rest
        return (gap * gap).sum(axis=1).tolist()
    exact = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist())) for row in part.tolist()]
    return [t if t < 2**63 else None for t in exact]


def whiten(embeddings: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows with a null or empty vector, or with a null, NaN or infinite entry (or one of 2^34 or more), are dropped. Vectors must share
    one length; if not, the most frequent one counts (of equals the longer) and the rest are dropped. Rows may repeat and ids may be
    null: every row counts and is returned. Components whose variance is zero but for rounding have no whitened value and are left
    out, so there may be fewer than ``components``; an empty table, a single vector or equal vectors give no rows.
    Of tied variances any basis is taken, the same for all rows. Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = stage(usable(embeddings, id_col, vector_col), "whole-entries")
    kind = embeddings.schema[id_col].dataType
    out_type = f"`{id_col}` {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], out_type)
    d, n = sizes["d"], sizes["n"]
    rows = rows.where(F.size("x") == d)
    s = np.zeros(d, np.int64)
    for row in rows.select("x").mapInArrow(_sums(d), "dim int, s long").groupBy("dim").agg(F.sum("s").alias("s")).collect():
        s[row["dim"]] = row["s"]
    e, v, trace = principal(reduce_rows(rows, n, s), n, components)
    k = len(e)
    if not k:
        return spark.createDataFrame([], out_type)
    products, sums = np.zeros((k, k)), np.zeros(k)
    for row in rows.select("x").mapInArrow(_moments(n, s, e, v), "i int, j int, m double").groupBy("i", "j").agg(F.sum("m").alias("m")).collect():
        if row["i"] < 0:
            sums[row["j"]] = row["m"]
        else:
            products[row["i"], row["j"]] = row["m"]
    error = float(np.abs(products / n - np.outer(sums / n, sums / n) - np.eye(k)).max())
    explained = e / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):  # each row becomes k
                b = whole.slice(at, 2000)
                x = _matrix(b.column(1), d)
                place = np.repeat(np.arange(len(x)), k)
                m = len(place)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(place)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(m, n)),
                        pa.array(_deviation(x, n, s), pa.int64()).take(pa.array(place)), pa.array(_projected(x, n, s, e, v).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, out_type)
