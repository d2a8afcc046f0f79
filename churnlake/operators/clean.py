"""Cleaning: imputation fitted on train, duplicates, outlier filter, projections.

Fitted constants (medians, modes) are tiny: they are collected once and
applied as literals, so Catalyst folds them into the projection of both
train and test and no join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.operators.profile import iqr_bounds, numeric_columns
from churnlake.operators.stats import quantile_table


def fit_medians(train: DataFrame, cols: Sequence[str], method: str | None = None) -> dict[str, float | None]:
    """Exact median of each column on train (fitted constants)."""
    if not cols:
        return {}
    q = quantile_table(train, cols, [0.5], method=method)
    return {c: q[((), c)][0] for c in cols}


def fill_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """``coalesce(col, constant)`` for each column.

    The column type is kept, but an integer column filled with a fractional number becomes double.
    """
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in values and values[c] is not None:
            v, kind = values[c], types[c]
            if kind in ("tinyint", "smallint", "int", "bigint") and isinstance(v, float) and not v.is_integer():
                kind = "double"
            out.append(F.coalesce(F.col(c).cast(kind), F.lit(v).cast(kind)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def impute_median_fit_train(train: DataFrame, test: DataFrame, cols: Sequence[str], method: str | None = None):
    """Medians fitted on train fill both train and test."""
    med = fit_medians(train, cols, method)
    return fill_constants(train, med), fill_constants(test, med)


def impute_median_all_numeric(df: DataFrame, method: str | None = None) -> DataFrame:
    """Every numeric column filled by its own median."""
    return fill_constants(df, fit_medians(df, numeric_columns(df), method))


def mode_of(df: DataFrame, col: str):
    """Most frequent non-null value; ties give the smallest value.

    ``groupBy`` + top-1 by (count desc, value asc): the counting is a
    distributed partial aggregate and the top-1 is TakeOrderedAndProject,
    so no task holds more than its share of distinct values.
    """
    row = (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("__n"))
        .orderBy(F.desc("__n"), F.asc(col))
        .limit(1)
        .first()
    )
    return None if row is None else row[col]


def impute_mode_fit_train(train: DataFrame, test: DataFrame, cols: Sequence[str]):
    """The train mode fills train and test."""
    modes = {c: mode_of(train, c) for c in cols}
    return fill_constants(train, modes), fill_constants(test, modes)


def impute_mode_all(df: DataFrame) -> DataFrame:
    """C4: whatever is still missing in any column is filled by that column's mode."""
    return fill_constants(df, {c: mode_of(df, c) for c in columns_with_nulls(df)})


def columns_with_nulls(*dfs: DataFrame) -> list[str]:
    """C5 helper: columns that have a null in any of the frames (one pass per frame)."""
    found: list[str] = []
    for df in dfs:
        row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns]).first()
        found += [c for c in df.columns if row[c] > 0 and c not in found]
    return found


def impute_where_needed(train: DataFrame, test: DataFrame, method: str | None = None):
    """Impute only columns with nulls in train or test (numeric: median, other: mode)."""
    need = [c for c in columns_with_nulls(train, test) if c in train.columns]
    num = set(numeric_columns(train))
    med = fit_medians(train, [c for c in need if c in num], method)
    modes = {c: mode_of(train, c) for c in need if c not in num}
    values = {**med, **modes}
    return fill_constants(train, values), fill_constants(test, {k: v for k, v in values.items() if k in test.columns})


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Exact-row distinct."""
    return df.dropDuplicates()


def outlier_rows(df: DataFrame, col: str, k: float = 1.5, method: str | None = None) -> DataFrame:
    """Rows strictly outside the IQR fences of ``col`` (bounds collected: 2 numbers)."""
    b = iqr_bounds(df, [col], k, method).first()
    lo, hi = b[f"lo__{col}"], b[f"hi__{col}"]
    return df.where((F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi)))


def project_drop(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    """Drop identifiers / target / raw text columns."""
    return df.drop(*drop)


def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Keep numeric columns only."""
    return df.select(*numeric_columns(df, exclude))


def align_columns(df: DataFrame, columns: Sequence[str], fill=0) -> DataFrame:
    """Reorder ``df`` to ``columns``; absent columns become ``fill``; extra columns dropped."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in columns])
