"""Evaluation: metrics, exact ROC-AUC, threshold search, leaderboards.

All operators read a score table ``(label, score[, group])`` and return small
DataFrames. Nothing row-level is collected; only bounded tables (a threshold
grid, a bracket's distinct scores up to a cap) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.operators.stats import order_statistics
from churnlake.session import written

EPS = 1e-15


def _f1(tp: Column, pos: Column, pred: Column) -> Column:
    """2 TP / (P + predicted); 0 when undefined."""
    return F.coalesce(F.try_divide(F.lit(2.0) * tp, (pos + pred).cast("double")), F.lit(0.0))


def apply_threshold(df: DataFrame, score: str, t: float | Column, out: str = "pred") -> DataFrame:
    """(score >= t) as 0/1."""
    tc = t if isinstance(t, Column) else F.lit(float(t))
    return df.withColumn(out, (F.col(score) >= tc).cast("int"))


def classification_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 of the positive class (0 when undefined), one pass."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    tp = F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0))
    fp = F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0))
    fn = F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0))
    n = F.count(F.lit(1))
    correct = F.sum(F.when(y == p, 1).otherwise(0))
    agg = df.groupBy(*by).agg(
        n.alias("n"), correct.alias("correct"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn")
    )
    return agg.select(
        *by,
        (F.col("correct") / F.col("n")).alias("accuracy"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0)).alias("recall"),
        _f1(F.col("tp"), F.col("tp") + F.col("fn"), F.col("tp") + F.col("fp")).alias("f1"),
    )


def positive_rate(df: DataFrame, score: str, t: float) -> DataFrame:
    """Share of rows with score >= t."""
    return df.agg(F.avg((F.col(score) >= F.lit(float(t))).cast("double")).alias("pos_rate"))


def prediction_summary(df: DataFrame, pred: str) -> DataFrame:
    """Number and share of predicted positives."""
    return df.agg(F.sum(F.col(pred)).cast("bigint").alias("n_pred_pos"), F.avg(F.col(pred).cast("double")).alias("pred_rate"))


def log_loss(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean binary cross-entropy with scores clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(EPS)), F.lit(1.0 - EPS))
    y = F.col(label).cast("double")
    ll = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return df.groupBy(*by).agg(F.avg(ll).alias("log_loss"))


# ----------------------------------------------------------------------------- ROC-AUC


def running_sums(df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``df`` with ``<c>_before`` for each column of ``sums``: its sum over the rows of the same group (``by``) with a smaller ``order``.

    Two phases, so that no window holds a whole group. Rows are cut into ``ranges`` (default: the session's shuffle
    partitions) by (group, order) and written with the number of their range. Totals of the ranges, at most one row a range and group,
    give the offsets; sums run inside each range. ``order`` must differ between the rows of a group; a null group is one of its own.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = written(df.repartitionByRange(n, *by, order).withColumn("__range", F.spark_partition_id()), "ranges")
    names = {c: f"__key_{j}" for j, c in enumerate([*by, "__range"])}
    totals = cut.groupBy(*[F.col(c).alias(k) for c, k in names.items()]).agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
    earlier = Window.partitionBy(*[names[c] for c in by]).orderBy(names["__range"]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*names.values(), *[F.coalesce(F.sum(f"__t_{c}").over(earlier), F.lit(0)).alias(f"__o_{c}") for c in sums])
    inside = Window.partitionBy(*names).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = cut.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__w_{c}") for c in sums])
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()]
    joined = within.join(offsets, reduce(lambda x, y: x & y, same))
    return joined.select(*df.columns, *[(F.col(f"__w_{c}") + F.col(f"__o_{c}")).alias(f"{c}_before") for c in sums])


def roc_auc(df: DataFrame, label: str, score: str, by: str | None = None, ranges: int | None = None) -> DataFrame:
    """Exact ROC-AUC (ties count half); per group of ``by``, any number of them, when given.

    Ties collapse in a partial aggregate (score -> positives, negatives). A positive beats the negatives with a smaller score,
    which :func:`running_sums` counts. The scores are read once.
    """
    keys, y = [by] if by else [], F.col(label).cast("int")
    ties = df.where(F.col(score).isNotNull()).groupBy(*keys, F.col(score).cast("double").alias("v")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(y == 1, 0).otherwise(1)).cast("double").alias("neg"),
    )
    beaten = F.col("pos") * (F.col("neg_before") + F.lit(0.5) * F.col("neg"))
    return running_sums(ties, "v", ["neg"], keys, ranges).groupBy(*keys).agg(
        F.try_divide(F.sum(beaten), F.sum("pos") * F.sum("neg")).alias("roc_auc")
    )


# ----------------------------------------------------------------------------- threshold search


def threshold_curve(df: DataFrame, label: str, score: str, grid: Sequence[float]) -> DataFrame:
    """F1, precision, recall and positive rate at every grid threshold, one pass.

    Each score is bucketed once (bucket = number of grid points <= score,
    ``Bucketizer`` binary search), then counts per bucket (<= len(grid)+1 rows)
    are turned into suffix sums: predicted(t_j) = rows in buckets > j.
    """
    g = [float(t) for t in grid]
    binned = Bucketizer(splits=[-float("inf"), *g, float("inf")], inputCol="__s", outputCol="__b").transform(
        df.select(F.col(label).cast("int").alias("__y"), F.col(score).cast("double").alias("__s")).where(F.col("__s").isNotNull())
    )
    counts = binned.groupBy("__b").agg(F.count(F.lit(1)).alias("cnt"), F.sum("__y").alias("pos"))
    spark = df.sparkSession
    dense = spark.range(len(g) + 1).select(F.col("id").cast("double").alias("__b"))
    dense = dense.join(F.broadcast(counts), "__b", "left").select(
        "__b", F.coalesce("cnt", F.lit(0)).alias("cnt"), F.coalesce("pos", F.lit(0)).alias("pos")
    )
    # <= len(grid) + 1 rows: a single-partition window is bounded.
    suffix = Window.orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, 0)
    allw = Window.partitionBy()
    sums = dense.select(
        "__b",
        F.sum("cnt").over(suffix).alias("pred"),
        F.sum("pos").over(suffix).alias("tp"),
        F.sum("pos").over(allw).alias("P"),
        F.sum("cnt").over(allw).alias("N"),
    )
    thr = F.element_at(F.array(*[F.lit(t) for t in g]), F.col("__b").cast("int"))
    return sums.where(F.col("__b") >= 1).select(
        (F.col("__b").cast("int") - 1).alias("grid_i"),
        thr.alias("threshold"),
        _f1(F.col("tp"), F.col("P"), F.col("pred")).alias("f1"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred").cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")), F.lit(0.0)).alias("recall"),
        (F.col("pred") / F.col("N")).alias("pos_rate"),
    )


def best_threshold(curve: DataFrame, start_t: float = 0.5, start_f1: float = 0.0) -> DataFrame:
    """I4: first grid point with the highest F1, replacing the start only if strictly better.

    The start row and the curve rows are ranked together (F1 desc; on a tie
    the start wins, then the lowest grid point), and the first row is kept.
    """
    start = curve.sparkSession.range(1).select(
        F.lit(float(start_t)).alias("threshold"), F.lit(float(start_f1)).alias("f1"), F.lit(-1).alias("grid_i")
    )
    cands = curve.select("threshold", "f1", "grid_i").unionByName(start)
    top = cands.orderBy(F.desc("f1"), F.asc("grid_i")).limit(1)
    return top.select(F.col("threshold").alias("best_thresh"), F.col("f1").alias("best_f1"))


def threshold_sweep_f1(df: DataFrame, label: str, score: str, grid: Sequence[float]) -> DataFrame:
    """I4 end to end: best (threshold, F1) over the grid plus the positive rate at it."""
    best = best_threshold(threshold_curve(df, label, score, grid)).first()
    t, f1 = best["best_thresh"], best["best_f1"]
    return df.agg(F.avg((F.col(score).cast("double") >= F.lit(t)).cast("double")).alias("pos_rate")).select(
        F.lit(t).alias("best_thresh"), F.lit(f1).alias("best_f1"), "pos_rate"
    )


def scores_at_ranks_desc(df: DataFrame, score: str, ranks: Sequence[int]) -> dict[int, float | None]:
    """Scores at 0-based positions of the descending order, all found in shared
    passes (:func:`~churnlake.operators.stats.order_statistics`)."""
    holder: dict[str, int] = {}

    def asc_ranks(n: int) -> set[int]:
        holder["n"] = n
        return {n - 1 - r for r in ranks if 0 <= r < n}

    values, counts = order_statistics(df, [score], asc_ranks)
    vals = values.get(((), score), {})
    n = counts.get(((), score), 0)
    return {r: (vals.get(n - 1 - r) if 0 <= r < n else None) for r in ranks}


def score_at_rank_desc(df: DataFrame, score: str, rank: int) -> float | None:
    """The score at 0-based position ``rank`` of the descending order."""
    return scores_at_ranks_desc(df, score, [rank])[rank]


def threshold_top_pct(df: DataFrame, label: str, score: str, pcts: Sequence[float]) -> DataFrame:
    """For each share ``pct``, threshold = score at rank int(pct * N) (descending), and its F1.

    The thresholds are found by :func:`score_at_rank_desc`; the F1 of all
    candidates comes from one pass of conditional sums.
    """
    n = df.where(F.col(score).isNotNull()).count()
    at = scores_at_ranks_desc(df, score, [int(p * n) for p in pcts])
    cands = [(float(p), int(p * n), at[int(p * n)]) for p in pcts]
    y = F.col(label).cast("int")
    s = F.col(score).cast("double")
    aggs = [F.sum(y).alias("P")]
    for i, (_, _, t) in enumerate(cands):
        hit = s >= F.lit(t)
        aggs += [F.sum(F.when(hit, y).otherwise(0)).alias(f"tp{i}"), F.sum(F.when(hit, 1).otherwise(0)).alias(f"pr{i}")]
    row = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(p).alias("pct"),
            F.lit(r).cast("bigint").alias("rank"),
            F.lit(t).cast("double").alias("threshold"),
            _f1(F.col(f"tp{i}"), F.col("P"), F.col(f"pr{i}")).alias("f1"),
        )
        for i, (p, r, t) in enumerate(cands)
    ]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def choose_threshold(df: DataFrame, label: str, score: str, grid: Sequence[float], pcts: Sequence[float] = ()) -> DataFrame:
    """Grid sweep, then each top-share candidate replaces the best only if its F1 is strictly higher."""
    best = threshold_curve(df, label, score, grid)
    b = best_threshold(best).first()
    t, f1 = b["best_thresh"], b["best_f1"]
    if pcts:
        for r in threshold_top_pct(df, label, score, pcts).orderBy("pct").collect():
            if r["f1"] > f1:
                t, f1 = r["threshold"], r["f1"]
    rate = df.agg(F.avg((F.col(score) >= F.lit(t)).cast("double")).alias("pos_rate"))
    return rate.select(F.lit(t).alias("best_thresh"), F.lit(f1).alias("best_f1"), "pos_rate")


def leaderboard(scores: DataFrame, model: str, label: str, score: str, t: float = 0.5) -> DataFrame:
    """I8: one row per model (accuracy, precision, recall, F1 at ``t``, ROC-AUC), best F1 first."""
    m = classification_metrics(apply_threshold(scores, score, t), label, "pred", by=[model])
    auc = roc_auc(scores, label, score, by=model)
    return m.join(auc, model, "left").orderBy(F.desc("f1"), F.asc(model))


def top_k(df: DataFrame, k: int, by: str, tie: str) -> DataFrame:
    """Best ``k`` rows by ``by`` (desc), ties by ``tie`` (asc)."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)
