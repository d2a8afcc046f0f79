"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in its features (words and
word beginnings); a document's is the noisy-or of its sentences, 1 - prod(1 - p). Only documents
are labelled: the gradient reaches a sentence in proportion to its share of the document's
score, so training finds out which sentences make a document toxic.

Fitting uses a bounded sample, at most ``max_clean`` and ``max_toxic`` labelled documents and ``max_chars`` characters of each class, picked
by a hash of the id. A sampled document counts for all labelled ones of its class, sampled or not (class size by
sample size), so that the bias and a fixed threshold mean the same at every input size. The document
frequencies of all features are a grouped aggregate; the ``max_features`` with the largest chi-square are
kept, and only their occurrences reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.common import held_out, md5_unit, stage, text_batches

SENTENCE_END = re.compile(r"[.!?\n]+")
TOKEN = re.compile(r"\w+")
BEGINNING = 5  # characters of a word's beginning, a feature of its own


def sentence_features(sentence: str) -> list[str]:
    """Of each different word: itself and, if longer, its beginning."""
    words = set(TOKEN.findall(sentence))
    return [*words, *(w[:BEGINNING] + "*" for w in words if len(w) > BEGINNING)]


def bags(text: str | None) -> list[list[str]]:
    """The features of every sentence with a word, over the whole lower-cased text."""
    found = map(sentence_features, SENTENCE_END.split((text or "").lower()))
    return [f for f in found if f]


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def logits(self, text: str | None) -> list[float]:
        get, out = self.weights.get, []
        for s in SENTENCE_END.split((text or "").lower()):
            words = set(TOKEN.findall(s))
            if words:
                out.append(self.bias + sum([get(w, 0.0) for w in words]) + sum([get(w[:BEGINNING] + "*", 0.0) for w in words if len(w) > BEGINNING]))
        return out

    def score(self, text: str | None) -> tuple[float, int, int]:
        """Noisy-or over the sentences, the number of offending ones (p >= 0.5), the place of the worst (-1: no sentence)."""
        z = np.array(self.logits(text))
        if not len(z):
            return 0.0, 0, -1
        return float(-np.expm1(-np.logaddexp(0, z).sum())), int((z >= 0).sum()), int(z.argmax())


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, n0, n1) per batch: documents of either class that have the feature."""
    for b in batches:
        seen = (Counter(), Counter())
        for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            seen[label].update({f for bag in bags(text) for f in bag})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in seen)], names=["feature", "n0", "n1"])


def _known_features(vocabulary: dict[str, int]):
    """Per document: label, number of sentences without a kept feature, and the others as (lengths, features)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blank, lengths, ids = [], [], []
            for text in b.column(1).to_pylist():
                found = [[vocabulary[f] for f in bag if f in vocabulary] for bag in bags(text)]
                blank.append(sum(not f for f in found))
                lengths.append([len(f) for f in found if f])
                ids.append([i for f in found for i in f])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(blank, pa.int32()), pa.array(lengths, pa.list_(pa.int32())), pa.array(ids, pa.list_(pa.int32()))], names=["label", "blank", "lengths", "ids"])

    return run


def fit_noisy_or(label: np.ndarray, blank: np.ndarray, lengths: list[np.ndarray], ids: list[np.ndarray], size: int, steps: int = 250, rate: float = 0.1, ridge: float = 1e-2, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Adam on the mean log-loss of the noisy-or, documents counted by ``weight``; returns the features' weights and the bias.

    With A = sum of softplus(z) over a document's sentences, P(toxic) = 1 - exp(-A); so dLoss/dA is 1
    for a clean document and -1 / (exp(A) - 1) for a toxic one, and dA/dz = sigmoid(z).
    """
    n = len(label)
    weight = np.ones(n) if weight is None else weight
    doc = np.repeat(np.arange(n), [len(x) for x in lengths])
    per = np.concatenate([*lengths, np.zeros(0, np.int64)]).astype(np.int64)
    sentence = np.repeat(np.arange(len(per)), per)
    feature = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[size] = -4.0
    for t in range(1, steps + 1):
        z = np.bincount(sentence, weights=w[feature], minlength=len(per)) + w[size]
        a = np.bincount(doc, weights=np.logaddexp(0, z), minlength=n) + blank * np.logaddexp(0, w[size])
        up = np.where(label == 1, -1 / np.expm1(np.clip(a, 1e-9, 500)), 1.0) * weight / weight.sum()
        dz = up[doc] / (1 + np.exp(-z))
        db = dz.sum() + (up * blank).sum() / (1 + np.exp(-w[size]))
        g = np.append(np.bincount(feature, weights=dz[sentence], minlength=size) + ridge * w[:size] / max(1, size), db)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:size], float(w[size])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_clean: int = 9000, max_toxic: int = 3000, max_features: int = 500, min_documents: int = 5, max_chars: int = 100_000_000) -> ToxicityModel:
    """Train on the rows of ``labels`` (callers leave out what is held out).

    Labels other than 0 and 1 and null ids are ignored; of documents that share an id one counts (by a hash of the text); without
    labelled documents the model scores everything 0. ``max_chars`` holds for each class: documents are taken in hash order until it is reached.
    """
    text_batches(docs.sparkSession)
    caps = {0: max_clean, 1: max_toxic}
    known = labels.where(F.col(label_col).isin(*caps) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_tx_id"), F.col(label_col).cast("int").alias("_tx_label")).distinct()
    stands_for = {r["_tx_label"]: max(1.0, r["n"] / max(1, caps[r["_tx_label"]])) for r in known.groupBy("_tx_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [known.where(F.col("_tx_label") == c).orderBy(md5_unit("toxic:", F.col("_tx_id")), "_tx_id").limit(most) for c, most in caps.items()]
    picked = F.broadcast(stage(picked[0].unionAll(picked[1]), "picked"))  # at most max_clean + max_toxic ids
    found = docs.select(F.col(id_col).alias("_tx_key"), F.col(text_col).alias("text")).join(picked, F.col("_tx_key") == F.col("_tx_id"))
    found = stage(found.groupBy("_tx_id", F.col("_tx_label").alias("label")).agg(F.min_by("text", F.xxhash64("text")).alias("text")), "found")
    # At most max_clean + max_toxic lengths are ordered here, without their texts.
    order = Window.partitionBy("label").orderBy(md5_unit("toxic:", F.col("_tx_id")), "_tx_id").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.select("_tx_id", "label", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("size"))
    within = stage(sizes.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0))).withColumn("taken", F.col("before") < max_chars), "within")
    for r in within.groupBy("label").agg((F.count(F.lit(1)) / F.greatest(F.count_if("taken"), F.lit(1))).alias("cut")).collect():
        stands_for[r["label"]] *= r["cut"]
    sample = stage(found.join(F.broadcast(within.where("taken").select("_tx_id", "label")), ["_tx_id", "label"]).select("label", "text"), "sample")
    counts = sample.mapInArrow(_frequencies, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    if not n1:
        return ToxicityModel({}, -50.0)
    w0, w1 = stands_for.get(0, 1.0), stands_for[1]
    all0, all1 = n0 * w0, n1 * w1
    total, have = all0 + all1, F.col("n0") * w0 + F.col("n1") * w1
    gap = F.col("n1") * w1 * F.lit(all0) - F.col("n0") * w0 * F.lit(all1)
    chi2 = total * gap * gap / (F.lit(max(all0, 1.0) * all1) * have * F.greatest(total - have, F.lit(1.0)))
    best = counts.where(F.col("n0") + F.col("n1") >= min_documents).orderBy(chi2.desc(), "feature").limit(max_features).select("feature").collect()
    vocabulary = {r["feature"]: k for k, r in enumerate(best)}
    rows = sample.select("label", "text").mapInArrow(_known_features(vocabulary), "label int, blank int, lengths array<int>, ids array<int>").toPandas()
    label = rows["label"].to_numpy()
    w, bias = fit_noisy_or(label, rows["blank"].to_numpy(), list(rows["lengths"]), list(rows["ids"]), len(vocabulary), weight=np.where(label == 1, w1, w0))
    return ToxicityModel({f: float(w[k]) for f, k in vocabulary.items() if abs(w[k]) > 1e-3}, bias)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_tx``: a struct of score (0..1), n_sentences (offending ones) and worst (place of the worst, -1: none).

    Null and empty texts have no sentence and score 0. All columns pass through.
    """
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # max_features weights

    @F.pandas_udf("score double, n_sentences int, worst int")
    def run(text: pd.Series) -> pd.DataFrame:
        model = ToxicityModel(**sent.value)
        return pd.DataFrame([model.score(t) for t in text], columns=["score", "n_sentences", "worst"])

    return docs.withColumn("_tx", run(F.col(text_col)))


def offending_sentences(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per sentence whose probability is ``least`` or more: id, sentence (its place), begin, end (characters), probability."""
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ToxicityModel(**sent.value)
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text, at, place = text or "", 0, -1
                for e in [*((x.start(), x.end()) for x in SENTENCE_END.finditer(text)), (len(text), len(text))]:
                    if z := m.logits(text[at : e[0]]):
                        place += 1
                        p = float(1 / (1 + np.exp(-z[0])))
                        if p >= least:
                            rows.append((key, place, at, e[0], p))
                    at = e[1]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int32(), pa.int32(), pa.int32(), pa.float64())))], names=["id", "sentence", "begin", "end", "probability"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, sentence int, begin int, end int, probability double").withColumnRenamed("id", id_col)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic_sentences, worst_sentence of every row; rows held out by crc32 of the id are not trained on.

    Null and empty texts score 0; repeated rows score alike, one row each; an empty table gives none; other columns are not read.
    """
    model = fit(docs, labels.where(~held_out(F.col("doc_id"), folds, fold)))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), F.col("_tx.score").alias("score"), (F.col("_tx.score") >= threshold).cast("int").alias("predicted"), F.col("_tx.n_sentences").alias("n_toxic_sentences"), F.col("_tx.worst").alias("worst_sentence"))


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns; null and empty texts and repeated rows stay, an empty table stays empty."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"), folds, fold)))
    return score(docs, model).where(F.col("_tx.score") < threshold).select(*docs.columns)
