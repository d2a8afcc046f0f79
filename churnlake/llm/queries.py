"""The registered queries of this package and their DuckDB forms.

A query applies its operator, with production parameters, to its whole table and derives the
contract's columns from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import ball_search, bpe, exact_dedup, html_extract, language_id, license_scan, mixing, pairwise_quality, prefix_bpe, quality_rules, simhash, toxicity, whitening
from churnlake.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages; the text model counts all documents."""
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY, out_col="text").withColumnRenamed("text", "decoded")
    return decoded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = prefix_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).drop("text")
    return made.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP6_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
        row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g"""

OP8_SQL = r"""
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS total, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS k FROM s GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 2.0::DOUBLE * total AS cap FROM t),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
        sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
        1.5::DOUBLE * sum(total) OVER () AS budget FROM w),
l AS (SELECT max((budget - spent) / open_weight) FILTER (WHERE (budget - spent) / open_weight <= cap / weight) AS level FROM o),
p AS (SELECT source, total, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target FROM w, l),
q AS (SELECT *, CASE WHEN total > 0 THEN CAST(floor(target / total) AS BIGINT) ELSE 0 END AS whole FROM p),
c AS (SELECT s.*, q.total, q.target, q.whole, q.target - q.whole * q.total AS need,
        sum(size) OVER (PARTITION BY s.source ORDER BY u, doc_id ASC NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0::DOUBLE AS middle
      FROM s JOIN q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, total AS source_size, target, CAST(size * (whole + CASE WHEN need > 0 AND middle <= need THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c"""


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
size AS (SELECT CAST(count(*) AS BIGINT) AS N, CAST(sum(len(terms)) AS BIGINT) AS L FROM d WHERE len(terms) > 0),
i AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
tf AS (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY row, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, size WHERE term IN (SELECT term FROM q) GROUP BY term, N),
m AS (SELECT row, doc_id, CAST(100 - 90 + ((90 * CAST(len(terms) AS BIGINT) * N) // L) AS BIGINT) AS m FROM d, size),
s AS (SELECT item_id, q.text, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (row) GROUP BY item_id, q.text, row, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = [op1_language_id, op2_license_scan, op3_quality_rules, op4_bpe, op5_quality_classifier, op6_exact_dedup, op7_toxicity, op8_mixing, op9_simhash, op10_html_extraction, op11_embedding_whitening, op12_ranked_search, op13_prefix_bpe]
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": license_scan.oracle(), "op6_exact_dedup": OP6_SQL, "op8_mixing": OP8_SQL, "op12_ranked_search": OP12_SQL}
