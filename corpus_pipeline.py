"""From raw documents to token ids in five stages, each one of the operators of ``churnlake.llm``.

Every stage works on all rows its predecessor kept and is written as Parquet before the next reads it. All but the
last return the columns of documents; rows may repeat after mixing (one row per repetition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import bpe, exact_dedup, mixing, simhash, toxicity
from churnlake.llm.common import stage, table
from churnlake.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more for toxicity go. Empty and null texts stay."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints within 3 bits the one with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's share of 150 % of all words asks for."""
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row (packed unsigned 32-bit integers); text is what the ids decode to."""
    decoded = bpe.round_trip(docs, VOCABULARY, out_col="text").withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))
    return decoded.select("doc_id", "text", "lang", "source", "n_chars", "n_tokens", "token_ids")


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("simhash near-dedup", drop_near_copies), ("mixing", mix), ("bpe", tokenize)]

#: Toxicity scores come from a trained model, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
