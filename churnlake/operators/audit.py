"""Train/test identity overlap audit.

The reference walks overlapping ids row by row; here both questions are
semi joins: O(N) hash/sort-merge joins instead of O(ids x N) scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.session import materialised


def overlapping_keys(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both frames (each side is de-duplicated first: a hot key joins as one row)."""
    keys = train.select(key).distinct()
    return keys.join(test.select(key).distinct(), keys[key].eqNullSafe(test[key]), "left_semi")


def key_intersection_count(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Number of distinct keys in both frames."""
    return overlapping_keys(train, test, key).agg(F.count(F.lit(1)).alias("n_overlap"))


def key_coverage(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Share of test rows whose key occurs in train.

    One left join against the distinct train keys (flagged) and one
    aggregate; the distinct keys are a partial aggregate, so a hot key
    collapses before the shuffle.
    """
    keys = materialised(train.select(key).distinct().withColumn("__hit", F.lit(1)))
    j = test.select(key).join(keys, on=key, how="left")
    return j.agg(F.count(F.lit(1)).alias("n_test"), F.count("__hit").alias("n_covered")).select(
        "n_test", "n_covered", F.try_divide(F.lit(100.0) * F.col("n_covered"), F.col("n_test").cast("double")).alias("pct_covered")
    )


def identity_match_audit(
    train: DataFrame,
    test: DataFrame,
    key: str,
    attrs: Sequence[str],
    limit_keys: int | None = None,
) -> DataFrame:
    """Among test rows whose key also occurs in train, how many have a
    train row equal on ``key`` and every attribute (nulls never match).

    ``limit_keys`` restricts the audit to the smallest ``limit_keys``
    overlapping keys (a top-k on the key, made deterministic by the order).
    """
    keys = overlapping_keys(train, test, key)
    if limit_keys is not None:
        keys = keys.orderBy(key).limit(limit_keys)
    keys = materialised(keys)
    match_on = [key, *attrs]
    scope = test.select(*match_on).join(keys, on=key, how="left_semi")
    identities = materialised(train.select(*match_on).dropDuplicates().withColumn("__hit", F.lit(1)))
    j = scope.join(identities, on=match_on, how="left")
    return j.agg(F.count(F.lit(1)).alias("n_total"), F.count("__hit").alias("n_matched")).select(
        "n_total",
        "n_matched",
        F.try_divide(F.lit(100.0) * F.col("n_matched"), F.col("n_total").cast("double")).alias("pct_matched"),
    )
