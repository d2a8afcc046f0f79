"""Smoothed target encoding, out-of-fold and fitted.

TE(key) = (n * mean + m * prior) / (n + m); an unseen key gets the prior.

Out-of-fold without a loop over folds: one aggregate per key gives the
totals S, N and the s_f, n_f of the folds in which the key occurs (as a map); the value for a
row of fold f is (S - s_f + m * prior_f) / (N - n_f + m). One aggregate and
one join replace k aggregates and k joins, and the same aggregate serves any
number of smoothing values.

Scale: the rows are aggregated once per key (partial aggregate, map-side
combine), so a key holding a third of all rows shrinks to one row per task
before the shuffle. The statistics are written before the join back on the
key: the join's inputs are then two plain shuffles, and AQE splits the
partition of a hot key or of null keys. Rows with a null key part never join and get the prior (pandas
drops null keys in ``groupby``). The rows are read by the fold totals, the
aggregate and the join, so pass a materialised frame (the pipelines
checkpoint the folded table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.session import materialised


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def smoothed(sum_y: Column, n: Column, m: float, prior: Column) -> Column:
    """(sum_y + m * prior) / (n + m); null when n + m = 0 (the caller falls back to the prior)."""
    return F.try_divide(sum_y + F.lit(float(m)) * prior, n.cast("double") + F.lit(float(m)))


def global_prior(df: DataFrame, target: str) -> float:
    """Mean of the target (one row collected)."""
    return df.agg(F.avg(F.col(target).cast("double"))).first()[0]


def te_stats(train: DataFrame, keys: str | Sequence[str], target: str, m: float, prior: float | None = None) -> DataFrame:
    """per key: count, mean of the target and the smoothed value ``te``."""
    keys = _keys(keys)
    prior = global_prior(train, target) if prior is None else prior
    y = F.col(target).cast("double")
    st = train.where(_not_null(keys)).groupBy(*keys).agg(F.count(y).alias("n"), F.sum(y).alias("sum_y"))
    return st.select(
        *keys,
        "n",
        (F.col("sum_y") / F.col("n")).alias("mean"),
        smoothed(F.col("sum_y"), F.col("n"), m, F.lit(prior)).alias("te"),
    )


def te_apply(train: DataFrame, df: DataFrame, keys: str | Sequence[str], target: str, m: float,
             out: str, prior: float | None = None) -> DataFrame:
    """stats from all of ``train``, looked up on ``df``; missing -> prior."""
    keys = _keys(keys)
    prior = global_prior(train, target) if prior is None else prior
    st = materialised(te_stats(train, keys, target, m, prior).select(*keys, F.col("te").alias("__te")))
    return df.join(st, on=keys, how="left").withColumn(out, F.coalesce(F.col("__te"), F.lit(prior))).drop("__te")


def te_self_inclusive(df: DataFrame, keys: str | Sequence[str], target: str, m: float, out: str) -> DataFrame:
    """stats from all rows applied to the same rows (leaks the row's own target)."""
    return te_apply(df, df, keys, target, m, out)


def oof_target_encode(
    df: DataFrame,
    keys: str | Sequence[str],
    target: str,
    fold_col: str,
    m: float | Sequence[float],
    out: str | Sequence[str],
    prior: str = "global",
) -> DataFrame:
    """Out-of-fold encoding of ``keys`` for every row of ``df``.

    ``m`` may be a list (one output column per smoothing value, one aggregate).
    ``prior``: 'global' = mean target of all rows; 'fold' = mean target of the
    rows outside the row's fold (the fold's training part).
    Folds are integers 0..k-1 (as the fold operators assign them).

    Plan: fold totals are k numbers (one small aggregate, collected). The rows
    are aggregated by (key, fold), then by key with a map of the folds that
    occur (partial aggregation; a hot key collapses map-side, a rare key carries
    no empty folds). The statistics are written before the join, and each
    row takes its own fold's entry from the map.
    """
    keys = _keys(keys)
    ms = [m] if isinstance(m, (int, float)) else list(m)
    outs = [out] if isinstance(out, str) else list(out)
    y = F.col(target).cast("double")
    fold = F.col(fold_col)
    idx = (fold + 1).cast("int")  # 1-based array position of the row's fold

    # k rows: count and sum of the target per fold.
    per_fold = {r[0]: (r[1], r[2] or 0.0) for r in df.groupBy(fold_col).agg(F.count(y), F.sum(y)).collect()}
    if not per_fold:
        return df.select("*", *[F.lit(None).cast("double").alias(o) for o in outs])
    k = max(per_fold) + 1
    if min(per_fold) < 0 or any(not isinstance(f, int) for f in per_fold):
        raise ValueError("fold column must hold integers 0..k-1")
    n_all = sum(v[0] for v in per_fold.values())
    s_all = sum(v[1] for v in per_fold.values())
    pg = s_all / n_all if n_all else None
    if prior == "global":
        prior_col = F.lit(pg).cast("double")
    else:
        pf = []
        for f in range(k):
            nf, sf = per_fold.get(f, (0, 0.0))
            pf.append((s_all - sf) / (n_all - nf) if n_all - nf > 0 else pg)
        prior_col = F.try_element_at(F.array(*[F.lit(p).cast("double") for p in pf]), idx)

    by_fold = df.where(_not_null(keys)).groupBy(*keys, fold.cast("int").alias("__k")).agg(F.count(y).alias("__n"), F.coalesce(F.sum(y), F.lit(0.0)).alias("__s"))
    per_key = by_fold.groupBy(*keys).agg(
        F.sum("__n").alias("__tn"),
        F.sum("__s").alias("__ts"),
        F.map_from_entries(F.collect_list(F.struct("__k", F.struct("__n", "__s")))).alias("__own"),
    )
    joined = df.join(materialised(per_key), on=keys, how="left").withColumn("__own", F.try_element_at("__own", fold.cast("int")))
    n_out = F.col("__tn") - F.coalesce(F.col("__own.__n"), F.lit(0))
    s_out = F.col("__ts") - F.coalesce(F.col("__own.__s"), F.lit(0.0))
    values = [F.coalesce(smoothed(s_out, n_out, mm, prior_col), prior_col).alias(o) for mm, o in zip(ms, outs)]
    tmp = ["__tn", "__ts", "__own"]
    return joined.select(*[c for c in joined.columns if c not in tmp], *values)
