"""SparkSession helpers used by tests, bench and examples.

Library code never creates a session; it takes the caller's. These helpers
only fill settings that are unset, so cluster-provided values win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "churnlake") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CHURNLAKE_DRIVER_MEMORY", "16g"))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    require_checkpoint_dir(spark)
    return spark


def require_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, for library code.

    Reads ``spark.checkpoint.dir`` (or the context's folder). Where neither is set, a session on one machine gets a scratch
    folder, and one on a cluster an error: there the folder must be a shared store.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running operators that write intermediate tables")
        folder = tempfile.mkdtemp(prefix="churnlake-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: later readers prune columns and push filters, and the
    table survives lost executors."""
    spark = df.sparkSession
    path = f"{require_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written once and read back as a plain scan.

    Used for the per-key side of a join: AQE splits a hot key only if both join inputs come
    straight from a shuffle or scan, which an aggregate on top of its shuffle does not.
    """
    return written(df, "table")
