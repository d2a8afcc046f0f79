"""Shared aggregate building blocks: quantiles and sample skewness.

``percentile`` (exact, linear interpolation, same as pandas) keeps a
value -> count map per group, so its memory grows with the number of
distinct values; ``approx=True`` switches to ``percentile_approx`` with a
bounded sketch for very large, high-cardinality columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from churnlake.session import written

APPROX_ACCURACY = 100_000


def quantiles(col: str | Column, probs: Sequence[float], approx: bool = False) -> Column:
    """Array of quantiles of ``col`` for ``probs`` (nulls ignored)."""
    c = F.col(col) if isinstance(col, str) else col
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if approx:
        return F.percentile_approx(c, arr, APPROX_ACCURACY)
    return F.percentile(c, arr)


def quantile(col: str | Column, p: float, approx: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if approx:
        return F.percentile_approx(c, F.lit(float(p)), APPROX_ACCURACY)
    return F.percentile(c, F.lit(float(p)))


def median(col: str | Column, approx: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return quantile(c, 0.5, approx) if approx else F.median(c)


def sample_skewness(col: str | Column) -> Column:
    """Bias-adjusted skewness G1 (pandas / DuckDB ``skewness``).

    Spark's ``skewness`` is the population g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    Undefined (null) for n < 3.
    """
    c = F.col(col) if isinstance(col, str) else col
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


# ----------------------------------------------------------------------------- distributed exact quantiles


def exact_quantiles(
    df,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    bins: int = 1024,
    max_collect: int = 4096,
) -> dict:
    """Exact linear-interpolation quantiles (pandas / ``quantile_cont``) without
    gathering a column's distinct values into one task.

    The order statistics they need are found by :func:`order_statistics`.
    Returns ``{(group tuple, col_name): [q for q in probs]}`` (None when empty).
    """

    def ranks(n: int) -> set[int]:
        out = set()
        for p in probs:
            pos = p * (n - 1)
            out.update({int(math.floor(pos)), int(math.ceil(pos))})
        return out

    values, counts = order_statistics(df, cols, ranks, by, bins, max_collect)
    out = {}
    for key, n in counts.items():
        qs = []
        for p in probs:
            pos = p * (n - 1)
            lo_r, hi_r = int(math.floor(pos)), int(math.ceil(pos))
            a, b = values[key][lo_r], values[key][hi_r]
            qs.append(a if a == b else a + (b - a) * (pos - lo_r))
        out[key] = qs
    groups = {g for g, _ in counts} or {()}
    for c in cols:
        for g in groups:
            out.setdefault((g, c), [None] * len(probs))
    return out


@dataclass
class _Range:
    """Values from ``lo`` to ``hi`` (both included) that hold a wanted rank, and about how many rows they are."""

    lo: float
    hi: float
    rows: float


SKETCH_K = 4096  # about 90 KB a sketch; a rank is off by more than RANK_ERROR in less than one of a million sketches
RANK_ERROR = 2 * 2.296 / SKETCH_K**0.9021  # twice the error of one in a hundred
COLLECT_RANGES = 256  # ranges of ``max_collect`` rows that one pass brings to the driver


def order_statistics(df, cols: Sequence[str], ranks_for, by: Sequence[str] = (), bins: int = 1024,
                     max_collect: int = 4096, max_groups: int = 10_000):
    """Values at 0-based ascending ranks, for every (group, column): sketched first, counted second.

    ``ranks_for(n)`` gives the wanted ranks for a (group, column) with ``n``
    non-null values. One wide aggregate takes a mergeable quantile sketch of every
    column; ``bins`` (at least 64) evenly spaced quantiles of it bracket each rank. The next pass
    counts exactly: rows below each bracket, and the distinct values inside. A bracket that
    may hold more than ``max_collect`` rows is sketched again first, which shrinks it by about ``bins`` / 8: two
    scans up to some 500,000 rows, one more for each further factor of a hundred, whatever the
    number of ranks. The counts decide alone: a rank that a sketch misses is sought
    again beside its bracket, so results do not depend on sketches.

    The input is read once: its wanted columns are written in the session's shared folder, which the passes scan; nothing is cached. The driver holds one state per group: more than ``max_groups`` raise
    an error, and a pass collects at most about 256 x ``max_collect`` values. Infinite values are counted at either end.

    Returns (``{(group, col): {rank: value}}``, ``{(group, col): n}``).
    """
    by, grid, spark = list(by), max(bins, 64), df.sparkSession
    rows = written(df.select(*by, *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)]), "narrow")
    found = _first_sketch(rows, by, len(cols), grid).limit(max_groups + 1).collect()
    if len(found) > max_groups:
        raise ValueError(f"more than {max_groups} groups: raise max_groups or aggregate with percentile_approx")
    groups = [tuple(r[b] for b in by) for r in found]
    values, counts, whole, open_ranks = {}, {}, {}, {}
    for g, r in enumerate(found):
        for i, c in enumerate(cols):
            st = r[f"s{i}"]
            if not st["n"]:
                continue
            counts[groups[g], c] = n = st["n"]
            values[groups[g], c] = done = {}
            whole[g, i] = st
            for k in ranks_for(n):
                if not 0 <= k < n:
                    continue
                if k < st["low"]:
                    done[k] = -math.inf
                elif k >= n - st["high"]:
                    done[k] = math.inf
                else:
                    open_ranks.setdefault((g, i), {})[k] = _bracket(st, k - st["low"], n - st["low"] - st["high"], grid, max_collect)
    while open_ranks:
        slots = {pair: _merged(ranks) for pair, ranks in open_ranks.items()}
        wide = {pair for pair, held in slots.items() if any(x.rows > max_collect for x in held)}
        if wide:
            slots = {pair: slots[pair] for pair in wide}
        else:
            fits = np.cumsum([len(held) for held in slots.values()]) <= max(COLLECT_RANGES, len(next(iter(slots.values()))))
            slots = {pair: held for (pair, held), fit in zip(slots.items(), fits) if fit}
        bounded, most = _with_bounds(spark, rows, by, groups, slots)
        seen = _sketched(bounded, most, grid) if wide else _counted(bounded, most)
        for (g, i), held in slots.items():
            st, ranks, done = whole[g, i], open_ranks[g, i], values[groups[g], cols[i]]
            for k in list(ranks):
                j = next(j for j, x in enumerate(held) if x.lo <= ranks[k].lo <= x.hi)
                got = _narrowed(seen[g][f"s{i}_{j}"], held[j], k, st, grid, max_collect) if wide else _resolved(seen.get((g, i), {}), held, k, st)
                if isinstance(got, _Range):
                    ranks[k] = got
                else:
                    done[k] = got
                    del ranks[k]
            if not ranks:
                del open_ranks[g, i]
    return values, counts


def _quantiles_of(x: Column, n: Column, grid: int) -> Column:
    """``grid`` + 1 evenly spaced quantiles of the non-null ``x`` by a sketch."""
    # One foldable string: an array of literals a column would be thousands of plan nodes.
    shares = F.split(F.lit(" ".join(str(k / grid) for k in range(grid + 1))), " ").cast("array<double>")
    return F.when(n > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(x, F.lit(SKETCH_K)), shares))


def _first_sketch(rows, by, n_cols: int, grid: int):
    aggs, inf = [], float("inf")
    for i in range(n_cols):
        v = F.col(f"__v{i}")
        x = F.when(F.abs(v) < inf, v)
        aggs.append(F.struct(
            F.count(F.when(~F.isnan(v), v)).alias("n"), F.count_if(v == -inf).alias("low"), F.count_if(v == inf).alias("high"),
            F.min(x).alias("mn"), F.max(x).alias("mx"), _quantiles_of(x, F.count(x), grid).alias("q"),
        ).alias(f"s{i}"))
    return rows.groupBy(*by).agg(*aggs)


def _bracket(st, at: int, n: int, grid: int, max_collect: int) -> _Range:
    """Where the value at rank ``at`` of the ``n`` sketched ones lies, but for the sketch's error."""
    if n <= max_collect:
        return _Range(st["mn"], st["mx"], n)
    share = (at + 0.5) / n
    first, last = math.floor((share - RANK_ERROR) * grid) - 1, math.ceil((share + RANK_ERROR) * grid) + 1
    lo = st["q"][first] if first > 0 else st["mn"]
    hi = st["q"][last] if last < grid else st["mx"]
    return _Range(lo, hi, 1 if lo == hi else n * (min(last, grid) - max(first, 0)) / grid)


def _merged(ranks: dict[int, _Range]) -> list[_Range]:
    """The ranges of all ranks, rising; those that overlap become one."""
    out: list[_Range] = []
    for x in sorted({(x.lo, x.hi, x.rows) for x in ranks.values()}):
        if out and x[0] <= out[-1].hi:
            out[-1] = _Range(out[-1].lo, max(out[-1].hi, x[1]), max(out[-1].rows, x[2]))
        else:
            out.append(_Range(*x))
    return out


def _with_bounds(spark, rows, by, groups, slots):
    """Rows with the group's number ``__g`` and its bounds ``__lo<column>_<slot>``, ``__hi...``; and the most slots of each column.

    Without groups the bounds are literals; with them a broadcast table of at most ``max_groups`` rows.
    """
    most: dict[int, int] = {}
    for (_, i), held in slots.items():
        most[i] = max(most.get(i, 0), len(held))
    names = [f"__{end}{i}_{j}" for i, n in most.items() for j in range(n) for end in ("lo", "hi")]
    table = []
    for g in sorted({g for g, _ in slots}):
        ends = []
        for i, n in most.items():
            held = slots.get((g, i), [])
            ends += [e for x in held for e in (x.lo, x.hi)] + [None] * (2 * (n - len(held)))
        table.append((*groups[g], g, *ends))
    if not by:
        return rows.select("*", F.lit(0).alias("__g"), *[F.lit(e).cast("double").alias(c) for c, e in zip(names, table[0][1:])]), most
    keys = [StructField(f"__by{k}", rows.schema[b].dataType) for k, b in enumerate(by)]
    bounds = spark.createDataFrame(table, StructType([*keys, StructField("__g", IntegerType()), *[StructField(c, DoubleType()) for c in names]]))
    same = [F.col(b).eqNullSafe(F.col(f"__by{k}")) for k, b in enumerate(by)]
    return rows.join(F.broadcast(bounds), reduce(lambda a, b: a & b, same)), most


def _sketched(bounded, most: dict[int, int], grid: int) -> dict:
    """For each group its counts below, at the ends of and strictly inside every bracket, and a sketch of the inside."""
    aggs = []
    for i, n in most.items():
        v = F.col(f"__v{i}")
        for j in range(n):
            lo, hi = F.col(f"__lo{i}_{j}"), F.col(f"__hi{i}_{j}")
            x = F.when((v > lo) & (v < hi), v)
            aggs.append(F.struct(
                F.count_if(v < lo).alias("below"), F.count_if(v == lo).alias("at_lo"), F.count_if((v == hi) & (lo < hi)).alias("at_hi"),
                F.count(x).alias("n"), F.min(x).alias("mn"), F.max(x).alias("mx"), _quantiles_of(x, F.count(x), grid).alias("q"),
            ).alias(f"s{i}_{j}"))
    return {r["__g"]: r for r in bounded.groupBy("__g").agg(*aggs).collect()}


def _narrowed(seen, held: _Range, rank: int, st, grid: int, max_collect: int) -> float | _Range:
    """The value at the rank if it is an end of the bracket, else where it lies."""
    at = rank - seen["below"]
    if at < 0:
        return _Range(st["mn"], math.nextafter(held.lo, -math.inf), seen["below"] - st["low"])
    if at < seen["at_lo"]:
        return held.lo
    at -= seen["at_lo"]
    if at < seen["n"]:
        return _bracket(seen, at, seen["n"], grid, max_collect)
    at -= seen["n"]
    if at < seen["at_hi"]:
        return held.hi
    return _Range(math.nextafter(held.hi, math.inf), st["mx"], st["n"] - st["high"] - rank + at - seen["at_hi"])


def _counted(bounded, most: dict[int, int]) -> dict:
    """``{(group, column): {segment: {value: rows}}}``. Brackets cut a column's values into segments, the odd ones inside; only
    these keep their values apart. A row is one small struct a column, which the partial aggregate collapses."""
    parts = []
    for i, n in most.items():
        v = F.col(f"__v{i}")
        steps = [F.coalesce(s.cast("int"), F.lit(0)) for j in range(n) for s in (v >= F.col(f"__lo{i}_{j}"), v > F.col(f"__hi{i}_{j}"))]
        segment = F.when(F.abs(v) < float("inf"), reduce(lambda a, b: a + b, steps))
        parts.append(F.struct(F.lit(i).alias("i"), segment.alias("segment"), F.when(segment % 2 == 1, v).alias("v")))
    long = bounded.select("__g", F.explode(F.array(*parts)).alias("r")).select("__g", "r.*").where("segment is not null")
    out: dict = {}
    for g, i, segment, v, n in long.groupBy("__g", "i", "segment", "v").count().collect():
        out.setdefault((g, i), {}).setdefault(segment, {})[v] = n
    return out


def _resolved(segments: dict, held: list[_Range], rank: int, st) -> float | _Range:
    """The value at the rank, or the range between two brackets that holds it."""
    below = st["low"]
    for segment in sorted(segments):
        n = sum(segments[segment].values())
        if below + n <= rank:
            below += n
            continue
        if segment % 2:
            for v in sorted(segments[segment]):
                below += segments[segment][v]
                if below > rank:
                    return v
        j = segment // 2
        lo = math.nextafter(held[j - 1].hi, math.inf) if j else st["mn"]
        hi = math.nextafter(held[j].lo, -math.inf) if j < len(held) else st["mx"]
        return _Range(lo, hi, n)
    raise RuntimeError("the input changed between two passes")


# Quantile strategies: "exact" = sketch and count above (default: never
# gathers a column into one task); "percentile" = Spark's exact aggregate
# (one pass, memory grows with distinct values); "approx" = bounded sketch.
QUANTILE_METHOD = "exact"


def quantile_table(df, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), method: str | None = None) -> dict:
    """``{(group tuple, col_name): [quantile per prob]}`` with the chosen strategy."""
    method = method or QUANTILE_METHOD
    if method == "exact":
        return exact_quantiles(df, cols, probs, by)
    by = list(by)
    approx = method == "approx"
    rows = df.groupBy(*by).agg(*[quantiles(F.col(c).cast("double"), probs, approx).alias(f"q__{c}") for c in cols]).collect()
    out = {}
    for r in rows:
        g = tuple(r[b] for b in by)
        for c in cols:
            out[(g, c)] = list(r[f"q__{c}"]) if r[f"q__{c}"] is not None else [None] * len(probs)
    return out


def lookup(mapping: dict, key_col: Column) -> Column:
    """Literal map lookup ``mapping[key_col]`` (small mappings only: fitted constants)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v).cast("double")]
    if not items:
        return F.lit(None).cast("double")
    return F.element_at(F.create_map(*items), key_col)
