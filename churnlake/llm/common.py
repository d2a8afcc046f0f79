"""Shared helpers: written intermediate tables, engine-neutral hashes, Arrow columns, let-bindings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words everywhere: runs of anything but ASCII white space. The same set as bytes.split().
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where that is unset, a session on one machine (tests) gets a
    scratch folder, and one on a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage, lets later readers prune columns, survives lost executors, and gives
    joins a plain scan as input, so that AQE can split a hot key (it cannot split the output
    of an aggregate).
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession, rows: int = 500, size: int = 64 << 20) -> None:
    """Hand at most ``rows`` rows and about ``size`` bytes at a time to Python: texts are wide, and Spark's 10,000 rows would fill a task's memory.

    Runtime settings of the session, only ever lowered here.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key).lower().removesuffix("b")
        if not now.lstrip("-").isdigit() or int(now) <= 0 or int(now) > most:
            spark.conf.set(key, str(most))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` (a one-element ``transform``)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def long_literal(bits: int) -> Column:
    """An unsigned 64-bit pattern as Spark's signed long."""
    return F.lit(bits - (1 << 64) if bits >= 1 << 63 else bits).cast("long")


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def md5_unit(seed: str, key: Column) -> Column:
    """A number in [0, 1) from md5(seed + key): the first 13 hex digits, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text leaves ``fold``; a null id is hashed as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)) == F.lit(fold)


def with_made_columns(df: DataFrame, sources: list[str], added: dict[str, T.DataType], start: Callable[[], Callable[..., list[list]]]) -> DataFrame:
    """``df`` with new binary or string columns (replacing any of their names), made batch by batch from the values of ``sources``.

    ``start`` is called once a task; what it returns takes one list of values a source and gives one list a new column.
    """
    kept = [c for c in df.columns if c not in added]
    schema = T.StructType([*df.select(*kept).schema.fields, *(T.StructField(c, t) for c, t in added.items())])
    types = [pa.binary() if isinstance(t, T.BinaryType) else pa.string() for t in added.values()]
    read = [*kept, *(c for c in sources if c not in kept)]
    places = [read.index(c) for c in sources]
    names = [*kept, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for b in batches:
            made = work(*(b.column(k).to_pylist() for k in places))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(kept))), *(pa.array(v, t) for v, t in zip(made, types))], names=names)

    text_batches(df.sparkSession)
    return df.select(*read).mapInArrow(run, schema)
