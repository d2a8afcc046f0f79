"""Categorical one-hot encoding, standard scaling and feature assembly.

Vocabularies and scaling constants are fitted on train and collected (their
size is bounded: a vocabulary larger than ``max_levels`` is refused), then
applied to any frame as literal expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LEVELS = 1000


def vocabulary(train: DataFrame, col: str, max_levels: int = MAX_LEVELS) -> list:
    """Sorted distinct non-null levels of ``col`` (refuses more than ``max_levels``)."""
    rows = (
        train.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).limit(max_levels + 1).collect()
    )
    if len(rows) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels; use target encoding instead")
    return [r[0] for r in rows]


def fit_one_hot(train: DataFrame, cols: Sequence[str], drop_first: bool) -> dict[str, list]:
    vocab = {c: vocabulary(train, c) for c in cols}
    return {c: (v[1:] if drop_first else v) for c, v in vocab.items()}


def dummy_name(col: str, level) -> str:
    return f"{col}_{level}"


def apply_one_hot(df: DataFrame, levels: dict[str, list], keep_source: bool = False) -> DataFrame:
    """0/1 dummy per kept level; null or unseen levels give all zeros."""
    dummies = [
        F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(dummy_name(c, v))
        for c, vs in levels.items()
        for v in vs
    ]
    out = df.select("*", *dummies)
    return out if keep_source else out.drop(*levels)


def one_hot_full(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K dummies for k train levels."""
    return apply_one_hot(df, fit_one_hot(train, cols, drop_first=False))


def one_hot_drop_first(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K-1 dummies, the first sorted train level dropped."""
    return apply_one_hot(df, fit_one_hot(train, cols, drop_first=True))


def fit_standard_scaler(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std (ddof=0) per column, nulls ignored; zero std -> scale 1."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m__{c}"), F.stddev_pop(x).alias(f"s__{c}")]
    row = train.agg(*aggs).first()
    out = {}
    for c in cols:
        s = row[f"s__{c}"]
        out[c] = (row[f"m__{c}"], s if s not in (None, 0.0) else 1.0)
    return out


def apply_standard_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.select(
        *[
            ((F.col(c).cast("double") - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c) if c in params else F.col(c)
            for c in df.columns
        ]
    )


def standard_scale(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / std with train constants."""
    return apply_standard_scaler(df, fit_standard_scaler(train, cols))


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector from columns already on the row (no join)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)
