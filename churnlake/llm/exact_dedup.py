"""Exact de-duplication by two passes over Bloom counters.

Pass 1 adds every text's digest to an array of counters that stop at two, and keeps one bit per
counter: "hit twice or more". Pass 2 tests each digest against those bits. Equal texts hit the
same counters, so a repeated text always passes the test; a text seen once passes it with a
probability of (1 - exp(-HASHES / bits_per_row)) ** HASHES, 0.5 % here. Only rows that pass are
shuffled (to be compared by their full SHA-256); all others go straight through.

The filter's size follows the number of rows up to ``max_filter_bits``. Beyond it the digests are
written in shards by digest prefix, and each shard gets a filter of its own. A shard's marked rows are
written and its filter is freed before the next shard starts: the driver and the executors hold
``max_filter_bits / 8`` bytes of filter at any input size.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.llm.common import batch, shared_folder, stage, text_batches

HASHES = 3
SLICE_BITS = 16  # counters per row of the merged filter: 2 ** SLICE_BITS
HELD_WORDS = 1 << 20  # digest words a task counts at once
COPIES = 1 << 16  # rows written out at once of those equal in id and text


def digest(data: bytes) -> bytes:
    """SHA-256 of the text with A-Z lowered (bytes.lower() changes ASCII letters only)."""
    return hashlib.sha256(data.lower()).digest()


def positions(h: np.ndarray, bits: int) -> np.ndarray:
    """HASHES counter positions per digest word, by double hashing; shape (n, HASHES)."""
    h = h.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    at = h[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)[None, :]
    return at & np.uint64(bits - 1)


@F.pandas_udf(T.BinaryType())
def sha_of(text: pd.Series) -> pd.Series:
    """The digest of each text; null counts as empty."""
    return pd.Series([digest((x or "").encode()) for x in text], dtype=object)


def _count_hits(bits: int):
    """Per slice and ``HELD_WORDS`` rows of a task: the offsets hit once and those hit more often, as packed 16-bit numbers."""

    schema = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])

    def counted(words: list[np.ndarray]) -> pa.RecordBatch:
        at, n = np.unique(np.concatenate([positions(w, bits).ravel() for w in words]), return_counts=True)
        slices = (at >> np.uint64(SLICE_BITS)).astype(np.int32)
        offsets = (at & np.uint64((1 << SLICE_BITS) - 1)).astype("<u2")
        ids, starts = np.unique(slices, return_index=True)
        ends = np.append(starts[1:], len(slices))
        once = [offsets[a:b][n[a:b] == 1].tobytes() for a, b in zip(starts, ends)]
        more = [offsets[a:b][n[a:b] > 1].tobytes() for a, b in zip(starts, ends)]
        return batch(schema, ids.tolist(), once, more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False))
            size += b.num_rows
            if size >= HELD_WORDS:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    return run


def _merge_slice(key: tuple, rows: pa.Table) -> pa.Table:
    """One slice of the filter: the counters that all tasks together hit at least twice."""
    hits = np.zeros(1 << SLICE_BITS, dtype=np.uint8)
    for once, more in zip(rows["once"].to_pylist(), rows["more"].to_pylist()):
        o = np.frombuffer(once, dtype="<u2")  # distinct within a row, so plain indexing adds each once
        hits[o] = np.minimum(hits[o] + 1, 2)
        hits[np.frombuffer(more, dtype="<u2")] = 2
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "twice": pa.array([np.packbits(hits == 2, bitorder="little").tobytes()], pa.binary())})


def bloom_filter(digests: DataFrame, bits: int) -> Broadcast:
    """The "hit twice" bits of all digests, as a broadcast of at most ``bits / 8`` bytes."""
    merged = digests.select("_xd_h").mapInArrow(_count_hits(bits), "slice int, once binary, more binary").groupBy("slice").applyInArrow(_merge_slice, "slice int, twice binary")
    out = np.zeros(bits // 8, dtype=np.uint8)
    width = (1 << SLICE_BITS) // 8
    for row in merged.toLocalIterator():  # at most bits / 2 ** SLICE_BITS rows of 8 KiB
        part = np.frombuffer(row["twice"], dtype=np.uint8)
        out[row["slice"] * width : (row["slice"] + 1) * width] = part[: bits // 8]
    return digests.sparkSession.sparkContext.broadcast(out)


def hit_twice(found: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = positions(h, len(found) * 8)
    return ((found[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _test(filter_bits: Broadcast):
    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(hit_twice(filter_bits.value, h.to_numpy()))

    return maybe


def _digest_and_test(filter_bits: Broadcast):
    @F.pandas_udf("sha binary, maybe boolean")
    def both(text: pd.Series) -> pd.DataFrame:
        shas = [digest((x or "").encode()) for x in text]
        words = np.frombuffer(b"".join(s[:8] for s in shas), dtype=">i8").astype(np.int64)
        return pd.DataFrame({"sha": pd.Series(shas, dtype=object), "maybe": hit_twice(filter_bits.value, words)})

    return both.asNondeterministic()


def with_digest(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_xd_sha`` (SHA-256 of the normalised text) and ``_xd_h`` (its first eight bytes)."""
    text_batches(docs.sparkSession)
    docs = docs.withColumn("_xd_sha", sha_of(F.col(text_col)))
    return docs.withColumn("_xd_h", F.conv(F.hex(F.substring("_xd_sha", 1, 8)), 16, -10).cast("long"))


def filter_shape(rows: int, bits_per_row: int, max_filter_bits: int) -> tuple[int, int]:
    """How many shards, and how many counters (a power of two) each shard's filter has."""
    shards = max(1, -(-rows * bits_per_row // max_filter_bits))
    return shards, 1 << max(SLICE_BITS, int(-(-rows // shards) * bits_per_row - 1).bit_length())


def write_shards(digested: DataFrame, shards: int, folder: str, by_shard: bool) -> None:
    """Write the rows by shard: the counters are picked by the low bits of the digest word, the shard by its high bits.

    ``by_shard`` (for narrow tables with an ``id``) shuffles the rows into ranges of (shard, hash of the id): about twice as many files as
    shards at most, and the shard of a very common text is split by its copies' ids. Otherwise rows stay in their tasks, and each task
    writes a file a shard.
    """
    sharded = digested.withColumn("_xd_shard", F.pmod(F.shiftrightunsigned("_xd_h", 40), F.lit(shards)).cast("int"))
    if by_shard:
        sharded = sharded.repartitionByRange(shards, "_xd_shard", F.xxhash64("id"))
    sharded.write.partitionBy("_xd_shard").parquet(folder)


def flagged(digested: DataFrame, shards: int, bits: int, by_shard: bool = False) -> DataFrame:
    """``digested`` with ``_xd_maybe``: whether the Bloom counters allow a second copy of the row's text."""
    if shards == 1:
        return digested.withColumn("_xd_maybe", _test(bloom_filter(digested, bits))("_xd_h"))
    spark, folder = digested.sparkSession, f"{shared_folder(digested.sparkSession)}/llm-shards-{uuid.uuid4().hex}"
    write_shards(digested, shards, f"{folder}/digests", by_shard)  # each pass then reads its own shard only
    whole = spark.read.parquet(f"{folder}/digests")
    marked = digested.withColumn("_xd_maybe", F.lit(True)).schema
    for k in range(shards):
        part = whole.where(F.col("_xd_shard") == k).select(*digested.columns)
        found = bloom_filter(part, bits)
        part.withColumn("_xd_maybe", _test(found)("_xd_h")).write.mode("append").parquet(f"{folder}/marked")
        found.destroy()
    return spark.read.schema(marked).parquet(f"{folder}/marked")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = 16, max_filter_bits: int = 1 << 28) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts (A-Z lowered) the largest id stays; null text counts as empty; a null id is
    smaller than any other. Of rows equal in both id and text one stays. Other columns are not
    read, so their names and nulls do not matter. An empty table gives an empty result.
    """
    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    light = stage(with_digest(light).drop("text"), "digests")  # the texts are read once; later passes read 48 bytes a row
    light = stage(flagged(light, *filter_shape(light.count(), bits_per_row, max_filter_bits), by_shard=True).select("id", F.col("_xd_sha").alias("sha"), "_xd_maybe"), "flags")
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    alone = light.where(~F.col("_xd_maybe")).select(F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    rows = stage(light.where("_xd_maybe").groupBy("sha", "id").agg(F.count(F.lit(1)).alias("n")), "repeats")
    groups = stage(rows.groupBy("sha").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size")), "groups")
    # Rows equal in id and text are written out in lots, never as one array.
    joined = rows.join(groups, "sha").withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    copies = F.sequence(F.col("lot") * COPIES + 1, F.least(F.col("n"), (F.col("lot") + 1) * COPIES))
    joined = joined.select("sha", "id", "keep_id", "group_size", F.explode(copies).alias("copy"))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return alone.unionAll(joined.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), sha))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = 16, max_filter_bits: int = 1 << 28) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, by the rules of ``exact_groups``.

    Rows whose text cannot have a copy pass straight through. The others are joined by
    (digest, id) with the one row of each group that stays; that key is never hot, as
    the group's copies differ in their id.
    """
    digests = stage(with_digest(docs.select(text_col), text_col).select("_xd_h"), "digests")
    shards, bits = filter_shape(digests.count(), bits_per_row, max_filter_bits)
    if shards > 1:
        marked = flagged(with_digest(docs, text_col), shards, bits).drop("_xd_h")
    else:
        # Digest and test in one function that is called once a row, so that a task needs one Python worker only: the
        # optimiser would call a deterministic one in the filter and again for the digest.
        marked = docs.withColumn("_xd", _digest_and_test(bloom_filter(digests, bits))(F.col(text_col)))
        marked = marked.select(*docs.columns, F.col("_xd.sha").alias("_xd_sha"), F.col("_xd.maybe").alias("_xd_maybe"))
    alone, maybe = marked.where(~F.col("_xd_maybe")), marked.where("_xd_maybe")
    stays = stage(maybe.groupBy("_xd_sha").agg(F.max(id_col).alias("_xd_id")), "stays").withColumnRenamed("_xd_sha", "_xd_key")
    chosen = maybe.join(stays, (F.col("_xd_sha") == F.col("_xd_key")) & F.col(id_col).eqNullSafe(F.col("_xd_id")))
    chosen = chosen.dropDuplicates(["_xd_key", "_xd_id"]).select(*marked.columns)
    return alone.unionAll(chosen).select(*docs.columns)
