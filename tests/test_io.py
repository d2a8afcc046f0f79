"""CSV scan with an explicit schema and the versioned submission sink."""

import tempfile

from pyspark.sql import functions as F

from churnlake.roles import TRAIN_SCHEMA
from churnlake.sources import io as A
from churnlake.sources.accounts import train_test, accounts
from tests.conftest import SF_SMALL


def test_csv_round_trip_keeps_nulls(spark):
    train, _ = train_test(accounts(spark, SF_SMALL))
    out = tempfile.mkdtemp(prefix="churnlake-csv-")
    train.write.mode("overwrite").option("header", True).csv(out + "/train.csv")
    back = A.csv_scan(spark, out + "/train.csv", TRAIN_SCHEMA)
    assert back.schema == TRAIN_SCHEMA or [f.name for f in back.schema] == [f.name for f in TRAIN_SCHEMA]
    assert back.count() == train.count()
    assert back.where(F.col("credit_score").isNull()).count() == train.where(F.col("credit_score").isNull()).count()
    assert back.exceptAll(train).count() == 0


def test_versioned_sink_counts_up(spark):
    folder = tempfile.mkdtemp(prefix="churnlake-sub-")
    df = spark.range(5).select(F.col("id"), (F.col("id") % 2).cast("int").alias("exit_status"))
    assert A.next_submission_counter(spark, folder) == 1
    n1, latest = A.versioned_sink(spark, df, folder)
    n2, _ = A.versioned_sink(spark, df, folder)
    assert n1.endswith("submission1.csv") and n2.endswith("submission2.csv")
    assert spark.read.option("header", True).csv(latest).count() == 5


def test_writers_at_once_never_share_a_number(spark):
    from concurrent.futures import ThreadPoolExecutor

    folder = tempfile.mkdtemp(prefix="churnlake-sub-")
    frames = [spark.range(3 + k).select(F.col("id"), F.lit(k).alias("exit_status")) for k in range(6)]
    hidden = [f"{folder}/_writing-{k}" for k in range(6)]
    for df, path in zip(frames, hidden):
        A.write_submission(df, path)
    with ThreadPoolExecutor(6) as pool:  # all of them want number 1
        won = list(pool.map(lambda path: A.publish(spark, path, f"{folder}/submission1.csv"), hidden))
    assert sum(won) == 1
    first = spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/submission1.csv")
    assert first.count() == 3 + won.index(True)
    assert A.latest_submission(spark, folder).endswith("/submission1.csv")
    numbered, _ = A.versioned_sink(spark, frames[0], folder)
    assert numbered.endswith("/submission2.csv") and A.latest_submission(spark, folder) == numbered


def test_resolve_id_column(spark):
    assert A.resolve_id_column(spark.range(1).withColumnRenamed("id", "record_id")) == "record_id"
    assert A.resolve_id_column(spark.range(1).withColumnRenamed("id", "x")) == "x"
