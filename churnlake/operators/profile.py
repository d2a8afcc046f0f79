"""Profiling aggregates.

Each operator is one or two passes over the table: statistics for all
columns are fused into a single ``agg`` and then unpivoted into long form
(one row per column), so the result size depends on the number of columns,
never on the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.operators.stats import lookup, quantile_table, sample_skewness


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns whose type is numeric (C9 ``select_numeric``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def shape(df: DataFrame) -> DataFrame:
    """B1: (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def _long(agg_row: DataFrame, cols: Sequence[str], fields: Sequence[str], name: str = "col_name") -> DataFrame:
    """Unpivot a one-row frame with ``{field}__{col}`` columns into one row per column."""
    structs = [
        F.struct(F.lit(c).alias(name), *[F.col(f"{fld}__{c}").alias(fld) for fld in fields]) for c in cols
    ]
    return agg_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def schema_report(df: DataFrame) -> DataFrame:
    """B2: column, dtype, non-null count (``info()``)."""
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.col(c)).alias(f"non_null__{c}") for c in df.columns]
    row = df.agg(*aggs)
    for c in df.columns:
        row = row.withColumn(f"dtype__{c}", F.lit(dtypes[c]))
    return _long(row, df.columns, ["dtype", "non_null"])


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None, method: str | None = None) -> DataFrame:
    """Count, mean, std (ddof=1), min, 25/50/75 %, max per numeric column.

    Moments come from one fused aggregate; quantiles from
    :func:`~churnlake.operators.stats.quantile_table` (distributed exact by default).
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [
            F.count(x).alias(f"count__{c}"),
            F.avg(x).alias(f"mean__{c}"),
            F.stddev_samp(x).alias(f"std__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
        ]
    narrow = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    out = _long(narrow.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    q = quantile_table(narrow, cols, [0.25, 0.5, 0.75], method=method)
    for i, name in enumerate(["p25", "p50", "p75"]):
        out = out.withColumn(name, lookup({c: q[((), c)][i] for c in cols}, F.col("col_name")))
    return out.select("col_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def median_skew(df: DataFrame, cols: Sequence[str], method: str | None = None) -> DataFrame:
    """B4 + B5: exact median and bias-adjusted skewness per column."""
    out = _long(df.agg(*[sample_skewness(F.col(c).cast("double")).alias(f"skew__{c}") for c in cols]), cols, ["skew"])
    q = quantile_table(df, cols, [0.5], method=method)
    return out.select("col_name", lookup({c: q[((), c)][0] for c in cols}, F.col("col_name")).alias("median"), "skew")


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column (one pass). Also B7: percentage of rows."""
    cols = list(cols) if cols is not None else df.columns
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"missing__{c}") for c in cols]
    row = df.agg(*aggs)
    for c in cols:
        row = row.withColumn(f"pct__{c}", F.col(f"missing__{c}") * 100.0 / F.col("__n"))
    return _long(row, cols, ["missing", "pct"])


def missing_pct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count and % of missing values, only columns that have some."""
    return missing_counts(df, cols).where(F.col("missing") > 0)


def missing_total(df: DataFrame) -> DataFrame:
    """Total number of null cells in the frame."""
    total = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("missing_total"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row on every column (nulls compare equal).

    ``groupBy(all columns)`` with partial aggregation: a heavily repeated row
    collapses map-side before the shuffle.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return groups.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str | None = None) -> DataFrame:
    """One-row frame with ``q1__c, q3__c, iqr__c, lo__c, hi__c`` for every column (fitted constants)."""
    q = quantile_table(df, cols, [0.25, 0.75], method=method)
    out = []
    for c in cols:
        q1, q3 = q[((), c)]
        iqr = None if q1 is None else q3 - q1
        vals = {"q1": q1, "q3": q3, "iqr": iqr,
                "lo": None if q1 is None else q1 - k * iqr, "hi": None if q1 is None else q3 + k * iqr}
        out += [F.lit(v).cast("double").alias(f"{n}__{c}") for n, v in vals.items()]
    return df.sparkSession.range(1).select(*out)


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str | None = None) -> DataFrame:
    """B10 + B11: Q1, Q3, IQR, bounds and counts strictly below / above / outside.

    Quantiles first (fitted constants), then one pass of conditional counts
    with the bounds as literals (no join).
    """
    b = iqr_bounds(df, cols, k, method).first()
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        lo, hi = F.lit(b[f"lo__{c}"]).cast("double"), F.lit(b[f"hi__{c}"]).cast("double")
        aggs += [F.count(F.when(x < lo, 1)).alias(f"n_low__{c}"), F.count(F.when(x > hi, 1)).alias(f"n_high__{c}")]
    row = df.agg(*aggs)
    for c in cols:
        for fld in ("q1", "q3", "iqr", "lo", "hi"):
            row = row.withColumn(f"{fld}__{c}", F.lit(b[f"{fld}__{c}"]).cast("double"))
        row = row.withColumn(f"n_outliers__{c}", F.col(f"n_low__{c}") + F.col(f"n_high__{c}"))
    return _long(row, cols, ["q1", "q3", "iqr", "lo", "hi", "n_low", "n_high", "n_outliers"])


def value_counts(df: DataFrame, col: str, sort: str = "count") -> DataFrame:
    """Frequency of each non-null value; ``sort`` = 'count' (desc) or 'key'."""
    out = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if sort == "count":
        return out.orderBy(F.desc("count"), F.asc(col))
    return out.orderBy(col)


def group_mean(df: DataFrame, key: str, target: str) -> DataFrame:
    """Mean of the target per non-null key (pandas ``groupby`` drops null keys)."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(F.col(target).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))
    )


def global_rate(df: DataFrame, target: str) -> DataFrame:
    """Mean of the target."""
    return df.agg(F.avg(F.col(target).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is right-closed; empty bins kept.

    min/max are fitted constants (one aggregate); rows are binned and counted
    in one pass; the ``bins``-row edge frame joins the counted bins.
    """
    spark = df.sparkSession
    x = F.col(col).cast("double")
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return spark.range(0).select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_left"), F.lit(0.0).alias("bin_right"),
                                     F.lit(0).cast("bigint").alias("count"))
    width = (F.lit(hi) - F.lit(lo)) / F.lit(float(bins))
    bin_of_x = F.lit(0) if hi == lo else F.least(F.floor((x - F.lit(lo)) / width), F.lit(bins - 1))
    counted = df.where(x.isNotNull()).groupBy(bin_of_x.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    b = F.col("bin")
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin")).select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("bin_left"),
        F.when(b == bins - 1, F.lit(hi)).otherwise(F.lit(lo) + (b + 1) * width).alias("bin_right"),
    )
    return edges.join(counted, "bin", "left").select(
        "bin", "bin_left", "bin_right", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")
    )


def boxplot_stats(df: DataFrame, col: str, by: str | None = None, method: str | None = None) -> DataFrame:
    """Q1, median, Q3, whiskers (furthest points within 1.5 IQR) and flier count.

    Per group when ``by`` is given (null groups dropped). The quartiles are
    fitted constants per group (a handful of classes), applied as a literal
    map lookup; whiskers and fliers are one grouped pass.
    """
    x = F.col(col).cast("double")
    keys = [by] if by else []
    src = df.where(x.isNotNull())
    if by:
        src = src.where(F.col(by).isNotNull())
    q = quantile_table(src, [col], [0.25, 0.5, 0.75], by=keys, method=method)
    groups = {g: v for (g, c), v in q.items() if v[0] is not None}
    if by:
        key = F.col(by)
        q1 = lookup({g[0]: v[0] for g, v in groups.items()}, key)
        med = lookup({g[0]: v[1] for g, v in groups.items()}, key)
        q3 = lookup({g[0]: v[2] for g, v in groups.items()}, key)
    else:
        v = groups.get((), [None, None, None])
        q1, med, q3 = (F.lit(x_).cast("double") for x_ in v)
    lo = q1 - F.lit(1.5) * (q3 - q1)
    hi = q3 + F.lit(1.5) * (q3 - q1)
    rows = src.select(*keys, x.alias("x"), q1.alias("q1"), med.alias("med"), q3.alias("q3"), lo.alias("lo"), hi.alias("hi"))
    inside = (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))
    return rows.groupBy(*keys).agg(
        F.first("q1").alias("q1"),
        F.first("med").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("n_fliers"),
    )


def grouped_density(df: DataFrame, col: str, by: str, gridsize: int = 200, cut: float = 3.0, cells: int | None = None) -> DataFrame:
    """Gaussian KDE per class, each class normalised on its own.

    Bandwidth by Scott's rule (sample std * n^(-1/5)); each class gets its own
    grid of ``gridsize`` points over [min - cut*bw, max + cut*bw].
    Equal values are pre-aggregated (weight = multiplicity). One aggregate then holds a kernel sum for each grid point, so a value stays one row and
    a task hands on classes x gridsize numbers.

    ``cells``: instead of by value, weights are gathered by linear binning on a grid of ``cells`` cells a bandwidth, which bounds the
    rows by the range and not by the distinct values. The kernel is interpolated between cell ends: a density is off by at
    most 1 / (8 * cells^2) of the kernel's peak, 1.2e-7 for 1024 cells. None is exact.
    """
    x = F.col(col).cast("double")
    src = df.where(x.isNotNull() & F.col(by).isNotNull())
    stats = src.groupBy(by).agg(
        F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("xmin"), F.max(x).alias("xmax")
    )
    stats = stats.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = stats.withColumn("g0", F.col("xmin") - F.lit(cut) * F.col("bw")).withColumn(
        "gstep", (F.col("xmax") - F.col("xmin") + F.lit(2 * cut) * F.col("bw")) / F.lit(float(gridsize - 1))
    )
    # Per-class constants (a few classes) are collected and applied as literal
    # lookups: no join on the class key, so a dominant class cannot skew a shuffle.
    consts = {r[by]: r for r in stats.collect() if r["bw"] is not None and r["bw"] > 0}
    key = F.col(by)
    bw, g0, gstep, n, xmin = (lookup({k: float(v[name]) for k, v in consts.items()}, key) for name in ("bw", "g0", "gstep", "n", "xmin"))
    points = src.where(key.isin(list(consts))).select(by, x.alias("x"))
    if cells is None:
        points = points.groupBy(by, "x").agg(F.count(F.lit(1)).cast("double").alias("w"))
    else:
        place = (F.col("x") - xmin) / bw * F.lit(float(cells))
        upper = place - F.floor(place)
        points = points.groupBy(by, F.floor(place).alias("cell")).agg(F.sum(1 - upper).alias("w"), F.sum(upper).alias("w_next"))
        points = points.select(by, "w", "w_next", (xmin + F.col("cell") * bw / F.lit(float(cells))).alias("x"))
    points = points.select("*", bw.alias("bw"), g0.alias("g0"), gstep.alias("gstep"))

    # Written as SQL text: hundreds of sums are built in one call.
    def mass(i: int) -> str:
        own = f"w * exp(-0.5D * pow((g0 + {i}D * gstep - x) / bw, 2))"
        return own if cells is None else own + f" + w_next * exp(-0.5D * pow((g0 + {i}D * gstep - x) / bw - {1 / cells!r}D, 2))"

    sums = points.groupBy(by).agg(F.expr("array(" + ", ".join(f"sum({mass(i)})" for i in range(gridsize)) + ")").alias("sums"))
    norm = F.lit(1.0 / (2.0 * 3.141592653589793) ** 0.5)
    return sums.select(by, F.posexplode("sums").alias("grid_i", "s")).select(
        by, "grid_i", (g0 + F.col("grid_i").cast("double") * gstep).alias("grid_x"), (F.col("s") * norm / (n * bw)).alias("density")
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every pair (i < j), pairwise-complete on nulls, one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def preview(df: DataFrame, n: int = 5, order_by: str = "id") -> DataFrame:
    """First ``n`` rows in an explicit order (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(order_by).limit(n)
