"""Registered queries: sources (A1) and profiling (B1-B19) on the accounts table."""

from __future__ import annotations

import uuid

from churnlake.operators import profile as P
from churnlake.plans.catalog import register
from churnlake.session import require_checkpoint_dir
from churnlake.sources.accounts import accounts, train_table
from churnlake.sources.io import csv_scan

TARGET = "exit_status"
NUMERICS = ["credit_score", "age", "tenure", "acc_balance", "prod_count", "has_card", "is_active", "estimated_salary"]
OUTLIER_COLS = ["credit_score", "age", "tenure", "acc_balance", "prod_count", "estimated_salary"]
TRAIN_DTYPES = [
    ("id", "bigint"), ("customer_id", "bigint"), ("last_name", "string"), ("credit_score", "double"),
    ("country", "string"), ("gender", "string"), ("age", "double"), ("tenure", "int"),
    ("acc_balance", "double"), ("prod_count", "double"), ("has_card", "int"), ("is_active", "int"),
    ("estimated_salary", "double"), ("exit_status", "int"),
]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


@register("a1_accounts_scan", "SELECT * FROM accounts")
def a1_accounts_scan(spark, sf_dir):
    return accounts(spark, sf_dir)


@register("a1_csv_scan", "SELECT * FROM train")
def a1_csv_scan(spark, sf_dir):
    """The training table written as CSV with a header and read by its explicit schema: nulls and doubles come back as they were."""
    path = f"{require_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    train_table(spark, sf_dir).write.option("header", True).csv(path)
    return csv_scan(spark, path)


@register("b01_shape", f"SELECT count(*) AS n_rows, CAST({len(TRAIN_DTYPES)} AS BIGINT) AS n_cols FROM train")
def b01_shape(spark, sf_dir):
    return P.shape(train_table(spark, sf_dir))


@register(
    "b02_schema_report",
    _union([f"SELECT '{c}' AS col_name, '{t}' AS dtype, count({c}) AS non_null FROM train" for c, t in TRAIN_DTYPES]),
)
def b02_schema_report(spark, sf_dir):
    return P.schema_report(train_table(spark, sf_dir))


_DESCRIBE_COLS = NUMERICS + [TARGET]


@register(
    "b03_describe_numeric",
    _union([
        f"SELECT '{c}' AS col_name, count({c}) AS count, avg({c}::DOUBLE) AS mean, stddev_samp({c}::DOUBLE) AS std, "
        f"min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS p25, quantile_cont({c}::DOUBLE, 0.5) AS p50, "
        f"quantile_cont({c}::DOUBLE, 0.75) AS p75, max({c})::DOUBLE AS max FROM train"
        for c in _DESCRIBE_COLS
    ]),
    rounded=("mean", "std", "min", "p25", "p50", "p75", "max"),
    digits=4,
)
def b03_describe_numeric(spark, sf_dir):
    return P.describe_numeric(train_table(spark, sf_dir), _DESCRIBE_COLS)


@register(
    "b04_median_skew",
    _union([
        f"SELECT '{c}' AS col_name, median({c}::DOUBLE) AS median, skewness({c}::DOUBLE) AS skew FROM train"
        for c in NUMERICS
    ]),
    rounded=("median", "skew"),
)
def b04_median_skew(spark, sf_dir):
    return P.median_skew(train_table(spark, sf_dir), NUMERICS)


_ALL_TRAIN = [c for c, _ in TRAIN_DTYPES]


@register(
    "b06_missing_counts",
    _union([
        f"SELECT '{c}' AS col_name, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
        f"(count(*) - count({c})) * 100.0 / count(*) AS pct FROM train"
        for c in _ALL_TRAIN
    ]),
    rounded=("pct",),
)
def b06_missing_counts(spark, sf_dir):
    return P.missing_counts(train_table(spark, sf_dir))


@register(
    "b07_missing_pct",
    "SELECT * FROM (" + _union([
        f"SELECT '{c}' AS col_name, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
        f"(count(*) - count({c})) * 100.0 / count(*) AS pct FROM accounts"
        for c in [c for c, _ in TRAIN_DTYPES]
    ]) + ") WHERE missing > 0",
    rounded=("pct",),
)
def b07_missing_pct(spark, sf_dir):
    return P.missing_pct(accounts(spark, sf_dir).drop("part5"))


@register(
    "b08_missing_total",
    "SELECT CAST(" + " + ".join(f"(count(*) - count({c}))" for c in _ALL_TRAIN) + " AS BIGINT) AS missing_total FROM train",
)
def b08_missing_total(spark, sf_dir):
    return P.missing_total(train_table(spark, sf_dir))




@register(
    "b09_duplicate_count",
    "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dup)) AS BIGINT) AS duplicates FROM dup",
    ctes="dup AS (SELECT * FROM train UNION ALL SELECT * FROM train WHERE id % 101 = 0)",
)
def b09_duplicate_count(spark, sf_dir):
    train = train_table(spark, sf_dir)
    return P.duplicate_count(train.unionAll(train.where("id % 101 = 0")))


def _iqr_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS col_name, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, "
        f"(SELECT count(*) FROM train WHERE {c} < q1 - 1.5 * (q3 - q1)) AS n_low, "
        f"(SELECT count(*) FROM train WHERE {c} > q3 + 1.5 * (q3 - q1)) AS n_high, "
        f"(SELECT count(*) FROM train WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers "
        f"FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM train)"
    )


@register("b10_iqr_outliers", _union([_iqr_sql(c) for c in OUTLIER_COLS]), rounded=("q1", "q3", "iqr", "lo", "hi"), digits=4)
def b10_iqr_outliers(spark, sf_dir):
    return P.iqr_outliers(train_table(spark, sf_dir), OUTLIER_COLS)


@register("b12_value_counts_gender", "SELECT gender, count(*) AS count FROM train WHERE gender IS NOT NULL GROUP BY gender")
def b12_value_counts_gender(spark, sf_dir):
    return P.value_counts(train_table(spark, sf_dir), "gender")


@register(
    "b12_value_counts_target",
    "SELECT exit_status, count(*) AS count FROM train WHERE exit_status IS NOT NULL GROUP BY exit_status",
)
def b12_value_counts_target(spark, sf_dir):
    return P.value_counts(train_table(spark, sf_dir), TARGET, sort="key")


@register(
    "b13_group_mean_country",
    "SELECT country, avg(exit_status::DOUBLE) AS rate, count(*) AS n FROM train WHERE country IS NOT NULL GROUP BY country",
    rounded=("rate",),
)
def b13_group_mean_country(spark, sf_dir):
    return P.group_mean(train_table(spark, sf_dir), "country", TARGET)


@register(
    "b13_group_mean_gender",
    "SELECT gender, avg(exit_status::DOUBLE) AS rate, count(*) AS n FROM train WHERE gender IS NOT NULL GROUP BY gender",
    rounded=("rate",),
)
def b13_group_mean_gender(spark, sf_dir):
    return P.group_mean(train_table(spark, sf_dir), "gender", TARGET)


@register(
    "b14_histogram_age",
    """
SELECT g.bin, g.lo + g.bin * (g.hi - g.lo) / 20.0 AS bin_left,
       CASE WHEN g.bin = 19 THEN g.hi ELSE g.lo + (g.bin + 1) * (g.hi - g.lo) / 20.0 END AS bin_right,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT CAST(i AS INTEGER) AS bin, lo, hi FROM range(20) t(i), mm) g
LEFT JOIN (
  SELECT CAST(CASE WHEN mm.hi = mm.lo THEN 0 ELSE least(floor((age - mm.lo) / ((mm.hi - mm.lo) / 20.0)), 19) END AS INTEGER) AS bin,
         count(*) AS cnt
  FROM train, mm WHERE age IS NOT NULL GROUP BY 1
) c ON g.bin = c.bin
""",
    rounded=("bin_left", "bin_right"),
    ctes="mm AS (SELECT min(age::DOUBLE) AS lo, max(age::DOUBLE) AS hi FROM train)",
)
def b14_histogram_age(spark, sf_dir):
    return P.histogram(train_table(spark, sf_dir), "age", 20)


_BOX_CTES = """
bq AS (SELECT exit_status, quantile_cont(age::DOUBLE, 0.25) AS q1, quantile_cont(age::DOUBLE, 0.5) AS med,
              quantile_cont(age::DOUBLE, 0.75) AS q3
       FROM train WHERE age IS NOT NULL AND exit_status IS NOT NULL GROUP BY exit_status),
bb AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM bq)
"""


@register(
    "b15_boxplot_age_by_target",
    """
SELECT t.exit_status, first(bb.q1) AS q1, first(bb.med) AS median, first(bb.q3) AS q3,
       min(CASE WHEN t.age BETWEEN bb.lo AND bb.hi THEN t.age END) AS whisker_low,
       max(CASE WHEN t.age BETWEEN bb.lo AND bb.hi THEN t.age END) AS whisker_high,
       count(CASE WHEN NOT (t.age BETWEEN bb.lo AND bb.hi) THEN 1 END) AS n_fliers
FROM train t JOIN bb ON t.exit_status = bb.exit_status
WHERE t.age IS NOT NULL GROUP BY t.exit_status
""",
    rounded=("q1", "median", "q3", "whisker_low", "whisker_high"),
    ctes=_BOX_CTES,
)
def b15_boxplot_age_by_target(spark, sf_dir):
    return P.boxplot_stats(train_table(spark, sf_dir), "age", by=TARGET)


@register(
    "b15_boxplot_credit",
    """
SELECT q1, med AS median, q3,
       (SELECT min(credit_score) FROM train WHERE credit_score BETWEEN lo AND hi) AS whisker_low,
       (SELECT max(credit_score) FROM train WHERE credit_score BETWEEN lo AND hi) AS whisker_high,
       (SELECT count(*) FROM train WHERE credit_score < lo OR credit_score > hi) AS n_fliers
FROM (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT quantile_cont(credit_score, 0.25) AS q1, quantile_cont(credit_score, 0.5) AS med,
         quantile_cont(credit_score, 0.75) AS q3 FROM train))
""",
    rounded=("q1", "median", "q3", "whisker_low", "whisker_high"),
    digits=4,
)
def b15_boxplot_credit(spark, sf_dir):
    return P.boxplot_stats(train_table(spark, sf_dir), "credit_score")


_KDE_GRID = 200
_KDE_CTES = f"""
ks AS (SELECT exit_status, count(age) AS n, stddev_samp(age) AS sd, min(age) AS xmin, max(age) AS xmax
       FROM train WHERE age IS NOT NULL AND exit_status IS NOT NULL GROUP BY exit_status),
kb AS (SELECT *, sd * pow(n::DOUBLE, -0.2) AS bw FROM ks),
kg AS (SELECT *, xmin - 3.0 * bw AS g0, (xmax - xmin + 6.0 * bw) / {float(_KDE_GRID - 1)} AS gstep FROM kb),
grid AS (SELECT exit_status, CAST(i AS INTEGER) AS grid_i, g0 + i * gstep AS grid_x, n, bw FROM kg, range({_KDE_GRID}) t(i)),
dx AS (SELECT exit_status, age AS x, count(*)::DOUBLE AS w FROM train
       WHERE age IS NOT NULL AND exit_status IS NOT NULL GROUP BY exit_status, age)
"""


@register(
    "b16_density_age_by_target",
    """
SELECT g.exit_status, g.grid_i, g.grid_x,
       sum(dx.w * exp(-0.5 * ((g.grid_x - dx.x) / g.bw) * ((g.grid_x - dx.x) / g.bw)))
         / sqrt(2.0 * pi()) / (g.n * g.bw) AS density
FROM grid g JOIN dx ON g.exit_status = dx.exit_status
GROUP BY g.exit_status, g.grid_i, g.grid_x, g.n, g.bw
""",
    rounded=("grid_x", "density"),
    ctes=_KDE_CTES,
)
def b16_density_age_by_target(spark, sf_dir):
    return P.grouped_density(train_table(spark, sf_dir), "age", TARGET, gridsize=_KDE_GRID)


_CORR_COLS = NUMERICS + [TARGET]


@register(
    "b17_corr_matrix",
    _union([
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}::DOUBLE, {b}::DOUBLE) AS corr FROM train"
        for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]
    ]),
    rounded=("corr",),
)
def b17_corr_matrix(spark, sf_dir):
    return P.corr_matrix(train_table(spark, sf_dir), _CORR_COLS)


@register("b18_global_rate", "SELECT avg(exit_status::DOUBLE) AS rate, count(*) AS n FROM train", rounded=("rate",))
def b18_global_rate(spark, sf_dir):
    return P.global_rate(train_table(spark, sf_dir), TARGET)


@register("b19_preview", "SELECT * FROM train ORDER BY id LIMIT 5")
def b19_preview(spark, sf_dir):
    return P.preview(train_table(spark, sf_dir), 5, "id")
