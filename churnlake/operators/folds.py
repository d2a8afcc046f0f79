"""Holdout splits and k-fold assignment.

Rows are ordered by an engine-neutral hash of the id (ties by id), so the
assignment is reproducible across runs, clusters and the SQL oracle.

Exact rank within class without a two-task window: the hash's top ``bits``
bits form a bucket; ``row_number`` runs inside (class, bucket) partitions
(2 x 2^bits independent window groups spread over all tasks), and the rank
adds the row count of earlier buckets of the same class, taken from a
(class, bucket) count table of at most n_classes x 2^bits rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.hashing import FOLD_SEED, hash32
from churnlake.operators.joins import bounded_broadcast

DEFAULT_BITS = 16


def rank_in_class(df: DataFrame, label: str, id_col: str = "id", seed: str = FOLD_SEED,
                  bits: int = DEFAULT_BITS, out: str = "rank_in_class") -> DataFrame:
    """1-based rank of each row inside its class, ordered by (hash(seed, id), id).

    The rows are shuffled on (class, bucket) and numbered by a window inside each bucket; the bucket
    sizes come from a second, narrow read of id and label. A null label is an error.
    """
    df = df.withColumn(label, F.when(F.col(label).isNull(), F.raise_error(F.lit(f"null in label column {label}"))).otherwise(F.col(label)))
    h = "__h"
    b = "__b"
    with_h = df.withColumn(h, hash32(id_col, seed)).withColumn(b, F.shiftright(F.col(h), 32 - bits))
    w = Window.partitionBy(label, b).orderBy(h, id_col)
    ranked = with_h.withColumn("__rn", F.row_number().over(w))
    counts = ranked.groupBy(label, b).agg(F.max("__rn").alias("__cnt"))
    before = Window.partitionBy(label).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label, b, F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"))
    # n_classes x 2^bits rows: small unless the label has very many classes; AQE broadcasts them then.
    joined = ranked.join(offsets, on=[label, b], how="left")
    return joined.withColumn(out, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__rn")).cast("bigint")).drop(
        h, b, "__rn", "__off"
    )


def stratified_kfold(df: DataFrame, label: str, k: int, id_col: str = "id", seed: str = FOLD_SEED,
                     out: str = "fold", bits: int = DEFAULT_BITS) -> DataFrame:
    """fold = (rank_in_class - 1) mod k; per-class fold sizes differ by at most one."""
    r = rank_in_class(df, label, id_col, seed, bits, out="__rank")
    return r.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank")


def stratified_holdout(df: DataFrame, label: str, frac: float = 0.2, id_col: str = "id", seed: str = "holdout",
                       out: str = "is_holdout", bits: int = DEFAULT_BITS) -> DataFrame:
    """The first ceil(frac * n_class) rows of each class (hash order) are the holdout."""
    r = rank_in_class(df, label, id_col, seed, bits, out="__rank")
    n_class = r.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    r = r.join(bounded_broadcast(n_class, 10_000), on=label, how="left")
    return r.withColumn(out, (F.col("__rank") <= F.ceil(F.col("__n") * F.lit(frac))).cast("int")).drop("__rank", "__n")


def kfold(df: DataFrame, k: int, id_col: str = "id", seed: str = "kfold", out: str = "fold") -> DataFrame:
    """Unstratified folds by hash; no shuffle, sizes equal in expectation."""
    return df.withColumn(out, (hash32(id_col, seed) % k).cast("int"))


def fold_slice(df: DataFrame, fold: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(training part = other folds, validation part = this fold)."""
    return df.where(F.col(fold_col) != fold), df.where(F.col(fold_col) == fold)
