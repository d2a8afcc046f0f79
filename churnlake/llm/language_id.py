"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence meet in the log-odds of each language:
* text: a naive Bayes model of character trigrams, counted over all labelled documents; since neighbouring
  trigrams overlap, its log-likelihood is tempered by ``TEMPER``;
* the language that the page's markup declares, weighed by how often that declaration goes with each language;
* the address suffix (top-level domain), weighed the same way;
* a prior of the host, smoothed towards its domain, which is smoothed towards all pages; the page itself is left out of it.

The tables for the last three are grouped aggregates of the text model's posteriors over all pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import stage, text_batches

BUCKETS = 1 << 16
TEMPER = 0.2
HOST_WEIGHT, DOMAIN_WEIGHT, TABLE_WEIGHT = 5.0, 20.0, 2.0  # pseudo-counts of the smoothing
MAX_LANGUAGES = 200
UNSHOWN = re.compile(r"<(script|style|noscript|template)\b", re.I)
UNSHOWN_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template")}
SPACE = re.compile(r"[\W\d_]+")
#: Comments and elements whose content is not markup of the page (left open, they run to its end), and html start tags.
ROOT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(script|style|title|textarea|template|iframe|xmp|noembed|noframes)\b.*?(?:</\1\s*>|\Z)|<html\b([^>]*)", re.S | re.I | re.A)
DECLARED = re.compile(r"\blang\s*=\s*[\"']?([a-z]{2,3})", re.I | re.A)



def shown(source: str) -> str:
    """A page's text: comments, scripts and the like with what they hold, and all other tags, become spaces. Linear: an end that is missing is sought once."""
    parts, at, last, missing = [], 0, source.rfind(">"), set()
    while 0 <= (begin := source.find("<", at)) < last:
        end = 0
        if source.startswith("<!--", begin) and "-->" not in missing:
            end = source.find("-->", begin + 4) + 3
            if end < 3:
                end = missing.add("-->") or 0
        elif (m := UNSHOWN.match(source, begin)) and (name := m[1].lower()) not in missing:
            if e := UNSHOWN_END[name].search(source, m.end()):
                end = e.end()
            else:
                missing.add(name)
        parts += (source[at:begin], " ")
        at = end or source.find(">", begin) + 1
    parts.append(source[at:])
    return "".join(parts)

def declaration(page: str) -> str:
    """The lower-cased language of the first html start tag that names one, wherever in the page it is; '' without one."""
    for m in ROOT.finditer(page):
        if m[2] and (found := DECLARED.search(m[2])):
            return found[1].lower()
    return ""


def trigrams(text: str) -> np.ndarray:
    """The hashed character trigrams of the whole text: lower-cased letters, anything else is one blank."""
    clean = " " + SPACE.sub(" ", text.lower()).strip() + " "
    c = np.frombuffer(clean.encode("utf-16-le", "replace"), dtype="<u2").astype(np.uint32)
    if len(c) < 3:
        return np.zeros(0, dtype=np.uint32)
    h = (c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77)) * np.uint32(5) ^ c[2:] * np.uint32(0xC2B2AE3D)
    return (h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) per task: at most languages * BUCKETS rows."""
    sums: dict[str, np.ndarray] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            sums[lang] += np.bincount(trigrams(text or ""), minlength=BUCKETS)
    for lang, s in sums.items():
        at = np.flatnonzero(s)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(s[at])], names=["lang", "bucket", "n"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities by bucket, shape (BUCKETS, languages), from all rows with a language.

    The table that reaches the driver has at most MAX_LANGUAGES * BUCKETS rows; more languages are refused.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = stage(rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    langs = [r["lang"] for r in counts.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((BUCKETS, max(1, len(langs))), 0.5)
    got = counts.toPandas()
    table[got["bucket"].to_numpy(), got["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(dtype=int)] += got["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def log_likelihoods(pages: DataFrame, table: np.ndarray, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, url, declared (lower-cased) and the text's log-likelihood by language."""
    sent = pages.sparkSession.sparkContext.broadcast(table)  # BUCKETS * languages numbers
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp = sent.value
        for b in batches:
            sources = [x or "" for x in b.column(2).to_pylist()]
            out = [logp[trigrams(shown(x))].sum(axis=0, dtype=np.float64).tolist() for x in sources]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(map(declaration, sources), pa.string()), pa.array(out, pa.list_(pa.float64()))], names=["id", "url", "declared", "text_ll"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, f"id {kind}, url string, declared string, text_ll array<double>")


def softmax(logits: Column) -> Column:
    up = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(up, lambda x: x / F.aggregate(up, F.lit(0.0), lambda a, y: a + y))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, host, declared, lang, probability, text_lang (by the text alone).

    Null or empty pages have no text evidence and follow the other three; a null address has host ''. A declaration outside the
    known languages is one class, 'other'. Ties go to the first language by code point. Repeated rows are
    judged alike. Without labelled documents lang is null. Other columns are not read.
    """
    text_batches(pages.sparkSession)
    langs, table = fit(docs)
    rows = log_likelihoods(pages, table, id_col, url_col, html_col)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = rows.withColumn("host", host).withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).withColumn("suffix", F.regexp_extract("host", r"([^.]+)$", 1))
    rows = rows.withColumn("declared", F.when(F.col("declared") == "", "none").when(F.col("declared").isin(langs), F.col("declared")).otherwise("other"))
    n = max(1, len(langs))
    tempered = F.transform("text_ll", lambda x: x * TEMPER)
    rows = stage(rows.withColumn("ll", tempered).drop("text_ll").withColumn("p", softmax(F.col("ll"))), "likelihoods")
    p = [F.get("p", F.lit(k)) for k in range(n)]

    def sums(by: list[str]) -> DataFrame:
        return stage(rows.groupBy(*by).agg(F.array(*[F.sum(x) for x in p]).alias("c")), "sums")

    total = rows.agg(*[F.sum(x).alias(str(k)) for k, x in enumerate(p)]).first()
    total = np.array([x or 0.0 for x in total]) + 1.0
    overall = (total / total.sum()).tolist()

    def evidence(c: Column) -> Column:
        """log P(value | language) / P(value) by language, smoothed towards no evidence."""
        count = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        share = F.array(*[F.lit(x) for x in overall])
        return F.transform(c, lambda x, k: F.log((x + TABLE_WEIGHT * F.get(share, k)) / ((count + TABLE_WEIGHT) * F.get(share, k))))

    hosts = sums(["host", "domain", "suffix"])
    domains = stage(hosts.groupBy("domain").agg(F.array(*[F.sum(F.get("c", F.lit(k))) for k in range(n)]).alias("d")), "domains")
    suffixes = stage(hosts.groupBy("suffix").agg(F.array(*[F.sum(F.get("c", F.lit(k))) for k in range(n)]).alias("c")).select("suffix", evidence(F.col("c")).alias("by_suffix")), "suffixes")
    hosts = hosts.withColumnRenamed("c", "h").join(domains, "domain").join(suffixes, "suffix").select("host", "h", "d", "by_suffix")
    hosts = stage(hosts, "hosts")
    said = {r["declared"]: r["e"] for r in sums(["declared"]).select("declared", evidence(F.col("c")).alias("e")).collect()}  # at most languages + 2 rows
    said = F.create_map(*[y for k, e in said.items() for y in (F.lit(k), F.array(*map(F.lit, e)))]) if said else F.create_map(F.lit(""), F.array(F.lit(0.0)))

    def without(c: Column) -> Column:
        """Counts less the page's own share."""
        return F.transform(c, lambda x, k: F.greatest(x - F.get("p", k), F.lit(0.0)))

    def smoothed(c: Column, towards: Column, weight: float) -> Column:
        count = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        return F.transform(c, lambda x, k: (x + weight * F.get(towards, k)) / (count + weight))

    joined = rows.join(hosts, "host").withColumn("d", without(F.col("d"))).withColumn("h", without(F.col("h")))
    joined = joined.withColumn("d", smoothed(F.col("d"), F.array(*map(F.lit, overall)), DOMAIN_WEIGHT))
    joined = joined.withColumn("h", smoothed(F.col("h"), F.col("d"), HOST_WEIGHT)).withColumn("said", F.element_at(said, F.col("declared")))
    logits = F.transform("ll", lambda x, k: x + F.log(F.get("h", k)) + F.get("by_suffix", k) + F.get("said", k))
    joined = joined.withColumn("q", softmax(logits))
    names = F.array(*map(F.lit, langs)) if langs else F.array(F.lit(None).cast("string"))
    best = lambda a: F.get(names, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    return joined.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "declared", best(F.col("q")).alias("lang"), F.array_max("q").alias("probability"), best(F.col("p")).alias("text_lang"))
