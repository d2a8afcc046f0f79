"""Lookup joins with a default, and size-checked broadcasting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.session import materialised


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it provably has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (``limit`` stops the scan
    early), so it is cheap even when the table turns out to be large. Beyond
    the bound the frame is returned as is and the join stays a shuffle join.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def lookup_join_default(
    df: DataFrame,
    table: DataFrame,
    keys: str | Sequence[str],
    value: str,
    default: Column | float,
    out: str | None = None,
) -> DataFrame:
    """``df[key].map(table[value]).fillna(default)`` as a left equi join.

    ``table`` must be unique on ``keys``. Rows whose key has a null part never
    match (SQL equality), so they get the default, as a pandas lookup does.
    The table is written before the join, so that the join's inputs are plain
    shuffles: AQE broadcasts a small table, and splits a hot or null key of ``df`` otherwise.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = out or value
    default_col = default if isinstance(default, Column) else F.lit(float(default))
    joined = df.join(materialised(table.select(*keys, F.col(value).alias("__lookup_v"))), on=keys, how="left")
    return joined.withColumn(out, F.coalesce(F.col("__lookup_v"), default_col)).drop("__lookup_v")

