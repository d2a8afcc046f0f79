"""Registered queries: evaluation and threshold search (I), score-table model steps.

Scores come from a deterministic stand-in (an engine-neutral hash of the id
mapped to [0, 1)), so the SQL oracle can rebuild the same score table; the
same operators run unchanged on real model scores in the pipelines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from churnlake.functions.grids import GRID_41, GRID_81, GRID_161, TOP_PCTS_B
from churnlake.functions.hashing import SCORE_SEEDS, duckdb_hash32, unit_score
from churnlake.operators import evaluate as I
from churnlake.plans.catalog import register
from churnlake.session import require_checkpoint_dir
from churnlake.sources.accounts import accounts, train_test

TARGET = "exit_status"
MODELS = ("a", "b", "c")


def _scored(spark, sf_dir):
    train, _ = train_test(accounts(spark, sf_dir))
    return train.select("id", TARGET, unit_score("id", SCORE_SEEDS[0]).alias("p"))


def _scored_models(spark, sf_dir):
    train, _ = train_test(accounts(spark, sf_dir))
    parts = [train.select(F.lit(m).alias("model"), "id", TARGET, unit_score("id", s).alias("p")) for m, s in zip(MODELS, SCORE_SEEDS)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _p_sql(seed: str) -> str:
    return f"CAST({duckdb_hash32('id', seed)} AS DOUBLE) / 4294967296.0"


SCORED_CTE = f"scored AS (SELECT id, exit_status, {_p_sql(SCORE_SEEDS[0])} AS p FROM train)"
MODELS_CTE = "scored_models AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, id, exit_status, {_p_sql(s)} AS p FROM train" for m, s in zip(MODELS, SCORE_SEEDS)
) + ")"


def _grid_values(grid) -> str:
    return "(VALUES " + ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(grid)) + ") AS g(grid_i, t)"


_METRICS_SQL = """
SELECT {by}count(*) FILTER (WHERE pred = exit_status)::DOUBLE / count(*) AS accuracy,
       coalesce(count(*) FILTER (WHERE pred = 1 AND exit_status = 1)::DOUBLE / nullif(count(*) FILTER (WHERE pred = 1), 0), 0.0) AS precision,
       coalesce(count(*) FILTER (WHERE pred = 1 AND exit_status = 1)::DOUBLE / nullif(count(*) FILTER (WHERE exit_status = 1), 0), 0.0) AS recall,
       coalesce(2.0 * count(*) FILTER (WHERE pred = 1 AND exit_status = 1)
                / nullif(count(*) FILTER (WHERE exit_status = 1) + count(*) FILTER (WHERE pred = 1), 0), 0.0) AS f1
FROM (SELECT *, CAST(p >= {t}::DOUBLE AS INTEGER) AS pred FROM {src}) {group}
"""


@register(
    "i01_classification_metrics",
    _METRICS_SQL.format(by="", t=0.5, src="scored", group=""),
    rounded=("accuracy", "precision", "recall", "f1"),
    ctes=SCORED_CTE,
)
def i01_classification_metrics(spark, sf_dir):
    return I.classification_metrics(I.apply_threshold(_scored(spark, sf_dir), "p", 0.5), TARGET, "pred")


def _auc_sql(src: str, by: str | None) -> str:
    """Mann-Whitney form: mid-ranks of positives (ties share the average rank)."""
    whole = f"PARTITION BY {by}" if by else ""
    tie = f"PARTITION BY {by}, p" if by else "PARTITION BY p"
    grp = f"{by}, " if by else ""
    gb = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {grp}(sum(CASE WHEN exit_status = 1 THEN mid END) - max(n_pos) * (max(n_pos) + 1) / 2.0)
       / (max(n_pos) * (max(n) - max(n_pos))) AS roc_auc
FROM (
  SELECT {grp}exit_status,
         rank() OVER ({whole} ORDER BY p) + (count(*) OVER ({tie}) - 1) / 2.0 AS mid,
         sum(exit_status) OVER ({whole}) AS n_pos, count(*) OVER ({whole}) AS n
  FROM {src})
{gb}
"""


@register("i02_roc_auc", _auc_sql("scored", None), rounded=("roc_auc",), ctes=SCORED_CTE)
def i02_roc_auc(spark, sf_dir):
    return I.roc_auc(_scored(spark, sf_dir), TARGET, "p")


@register(
    "i02_roc_auc_ties",
    _auc_sql("(SELECT id, exit_status, round(p, 2) AS p FROM scored)", None),
    rounded=("roc_auc",),
    ctes=SCORED_CTE,
)
def i02_roc_auc_ties(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("p", F.round("p", 2))
    return I.roc_auc(s, TARGET, "p", ranges=12)


@register(
    "i03_apply_threshold",
    "SELECT id, CAST(p >= 0.35::DOUBLE AS INTEGER) AS pred FROM scored",
    ctes=SCORED_CTE,
)
def i03_apply_threshold(spark, sf_dir):
    return I.apply_threshold(_scored(spark, sf_dir), "p", 0.35).select("id", "pred")


def _curve_sql(grid) -> str:
    return f"""
SELECT CAST(g.grid_i AS INTEGER) AS grid_i, g.t AS threshold,
       coalesce(2.0 * sum(CASE WHEN s.p >= g.t THEN s.exit_status ELSE 0 END)
                / nullif(sum(s.exit_status) + count(*) FILTER (WHERE s.p >= g.t), 0), 0.0) AS f1,
       coalesce(sum(CASE WHEN s.p >= g.t THEN s.exit_status ELSE 0 END)::DOUBLE / nullif(count(*) FILTER (WHERE s.p >= g.t), 0), 0.0) AS precision,
       coalesce(sum(CASE WHEN s.p >= g.t THEN s.exit_status ELSE 0 END)::DOUBLE / nullif(sum(s.exit_status), 0), 0.0) AS recall,
       count(*) FILTER (WHERE s.p >= g.t)::DOUBLE / count(*) AS pos_rate
FROM {_grid_values(grid)}, scored s
GROUP BY g.grid_i, g.t
"""


@register("i04_threshold_curve_161", _curve_sql(GRID_161), rounded=("f1", "precision", "recall", "pos_rate"), ctes=SCORED_CTE)
def i04_threshold_curve_161(spark, sf_dir):
    return I.threshold_curve(_scored(spark, sf_dir), TARGET, "p", GRID_161)


def _best_sql(grid) -> str:
    return f"""
SELECT CASE WHEN f1 > 0.0 THEN threshold ELSE 0.5 END AS best_thresh,
       CASE WHEN f1 > 0.0 THEN f1 ELSE 0.0 END AS best_f1,
       (SELECT avg(CAST(p >= (CASE WHEN c.f1 > 0.0 THEN c.threshold ELSE 0.5 END) AS DOUBLE)) FROM scored) AS pos_rate
FROM ({_curve_sql(grid)}) c
ORDER BY f1 DESC, grid_i LIMIT 1
"""


@register("i04_threshold_sweep_81", _best_sql(GRID_81), rounded=("best_thresh", "best_f1", "pos_rate"), ctes=SCORED_CTE)
def i04_threshold_sweep_81(spark, sf_dir):
    return I.threshold_sweep_f1(_scored(spark, sf_dir), TARGET, "p", GRID_81)


@register("i04_threshold_sweep_41", _best_sql(GRID_41), rounded=("best_thresh", "best_f1", "pos_rate"), ctes=SCORED_CTE)
def i04_threshold_sweep_41(spark, sf_dir):
    return I.threshold_sweep_f1(_scored(spark, sf_dir), TARGET, "p", GRID_41)


_TOP_SQL = """
SELECT pc.pct, pc.rk AS rank, r.p AS threshold,
       coalesce(2.0 * (SELECT sum(CASE WHEN p >= r.p THEN exit_status ELSE 0 END) FROM scored)
                / nullif((SELECT sum(exit_status) FROM scored) + (SELECT count(*) FROM scored WHERE p >= r.p), 0), 0.0) AS f1
FROM (SELECT pct, CAST(floor(pct * (SELECT count(*) FROM scored)) AS BIGINT) AS rk
      FROM (VALUES {pcts}) AS v(pct)) pc
JOIN (SELECT p, row_number() OVER (ORDER BY p DESC) - 1 AS rk FROM scored) r ON r.rk = pc.rk
"""


@register(
    "i05_threshold_top_pct",
    _TOP_SQL.format(pcts=", ".join(f"({p!r}::DOUBLE)" for p in TOP_PCTS_B)),
    rounded=("threshold", "f1"),
    digits=9,
    ctes=SCORED_CTE,
)
def i05_threshold_top_pct(spark, sf_dir):
    return I.threshold_top_pct(_scored(spark, sf_dir), TARGET, "p", TOP_PCTS_B)


@register("i06_positive_rate", "SELECT avg(CAST(p >= 0.35::DOUBLE AS DOUBLE)) AS pos_rate FROM scored", rounded=("pos_rate",), ctes=SCORED_CTE)
def i06_positive_rate(spark, sf_dir):
    return I.positive_rate(_scored(spark, sf_dir), "p", 0.35)


@register(
    "i07_prediction_summary",
    "SELECT CAST(sum(pred) AS BIGINT) AS n_pred_pos, avg(pred::DOUBLE) AS pred_rate FROM "
    "(SELECT CAST(p >= 0.35::DOUBLE AS INTEGER) AS pred FROM scored)",
    rounded=("pred_rate",),
    ctes=SCORED_CTE,
)
def i07_prediction_summary(spark, sf_dir):
    return I.prediction_summary(I.apply_threshold(_scored(spark, sf_dir), "p", 0.35), "pred")


@register(
    "i08_leaderboard",
    "SELECT m.*, a.roc_auc FROM (" + _METRICS_SQL.format(by="model, ", t=0.5, src="scored_models", group="GROUP BY model")
    + ") m LEFT JOIN (" + _auc_sql("scored_models", "model") + ") a ON m.model = a.model",
    rounded=("accuracy", "precision", "recall", "f1", "roc_auc"),
    ctes=MODELS_CTE,
)
def i08_leaderboard(spark, sf_dir):
    return I.leaderboard(_scored_models(spark, sf_dir), "model", TARGET, "p")


@register(
    "i10_top_k_thresholds",
    "SELECT * FROM (" + _curve_sql(GRID_161) + ") ORDER BY f1 DESC, grid_i LIMIT 5",
    rounded=("f1", "precision", "recall", "pos_rate"),
    ctes=SCORED_CTE,
)
def i10_top_k_thresholds(spark, sf_dir):
    return I.top_k(I.threshold_curve(_scored(spark, sf_dir), TARGET, "p", GRID_161), 5, "f1", "grid_i")


@register(
    "i11_log_loss",
    "SELECT model, avg(-(exit_status * ln(greatest(least(p, 1 - 1e-15), 1e-15)) + (1 - exit_status) * "
    "ln(1 - greatest(least(p, 1 - 1e-15), 1e-15)))) AS log_loss FROM scored_models GROUP BY model",
    rounded=("log_loss",),
    ctes=MODELS_CTE,
)
def i11_log_loss(spark, sf_dir):
    return I.log_loss(_scored_models(spark, sf_dir), TARGET, "p", by=["model"])


@register(
    "h17_fold_mean_scores",
    "SELECT id, avg(p) AS p FROM (" + " UNION ALL ".join(
        f"SELECT id, {_p_sql(f'fold{f}')} AS p FROM test" for f in range(5)
    ) + ") GROUP BY id",
    rounded=("p",),
)
def h17_fold_mean_scores(spark, sf_dir):
    from churnlake.operators.models import fold_mean_scores

    _, test = train_test(accounts(spark, sf_dir))
    parts = [test.select("id", unit_score("id", f"fold{f}").alias("p")) for f in range(5)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return fold_mean_scores(u, ["id"])


@register(
    "h18_blend",
    f"SELECT id, exit_status, 0.4::DOUBLE * {_p_sql('score')} + 0.2::DOUBLE * {_p_sql('score2')} + 0.4::DOUBLE * {_p_sql('score3')} AS p FROM train",
    rounded=("p",),
)
def h18_blend(spark, sf_dir):
    from churnlake.operators.models import blend

    train, _ = train_test(accounts(spark, sf_dir))
    s = train.select("id", TARGET, *[unit_score("id", sd).alias(m) for m, sd in zip(MODELS, SCORE_SEEDS)])
    return blend(s, {"a": 0.4, "b": 0.2, "c": 0.4}, "p").select("id", TARGET, "p")


@register(
    "a2_submission_table",
    "SELECT id, CAST(p >= 0.35::DOUBLE AS INTEGER) AS exit_status FROM (SELECT id, "
    f"{_p_sql('score')} AS p FROM test)",
)
def a2_submission_table(spark, sf_dir):
    from churnlake.sources.io import submission_table

    _, test = train_test(accounts(spark, sf_dir))
    return submission_table(test.select("id", unit_score("id", "score").alias("p")), "p", 0.35)


@register(
    "a3_versioned_sink",
    "SELECT v.version, t.id, CAST(t.p >= v.cut AS INTEGER) AS exit_status FROM (VALUES (1, 0.35::DOUBLE), (2, 0.6::DOUBLE)) AS v(version, cut), "
    f"(SELECT id, {_p_sql('score')} AS p FROM test) t",
)
def a3_versioned_sink(spark, sf_dir):
    """Two submissions published one after the other, read back by their numbers; the un-numbered copy equals the second."""
    from churnlake.sources import io as A

    folder = f"{require_checkpoint_dir(spark)}/submissions-{uuid.uuid4().hex}"
    _, test = train_test(accounts(spark, sf_dir))
    scored = test.select("id", unit_score("id", "score").alias("p"))
    first = A.submission_table(scored, "p", 0.35)
    paths = [A.versioned_sink(spark, first, folder)[0], *A.versioned_sink(spark, A.submission_table(scored, "p", 0.6), folder)]

    def back(path, version):
        return spark.read.schema(first.schema).option("header", True).csv(path).select(F.lit(version).alias("version"), "*")

    second, latest = back(A.latest_submission(spark, folder), 2), back(paths[2], 2)
    if A.latest_submission(spark, folder) != paths[1] or not second.exceptAll(latest).isEmpty():
        raise RuntimeError("the latest copy is not the last one published")
    return back(paths[0], 1).unionAll(second)


@register("a4_id_column_resolve", "SELECT id FROM test")
def a4_id_column_resolve(spark, sf_dir):
    from churnlake.sources.io import resolve_id_column

    _, test = train_test(accounts(spark, sf_dir))
    return test.select(resolve_id_column(test))
