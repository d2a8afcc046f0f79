"""Quality scores by Bradley-Terry pairwise ranking.

P(document a is preferred to b) = sigmoid(s(a) - s(b)) with s linear in the features of the whole text.
Every pair sets a good labelled document against a bad one, and the weights minimise the
logistic loss on feature differences (no intercept: it cancels). Scores then get their threshold
from a quantile: the share of bad labels among the training rows, taken of the training rows' scores.

The sample is bounded by ``max_per_class`` documents of each class, picked by a hash of the id;
each document meets ``opponents`` others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.llm.common import held_out, md5_unit, stage, text_batches

FEATURES = ["log_words", "few_words", "symbols", "bars", "exclaims", "capitals", "digits", "punctuation", "letters", "word_length", "long_words", "distinct_words", "repeated_words", "repeated_lines", "lines", "repeated_trigrams"]


def _class_masks() -> np.ndarray:
    """Weights per byte value for the counts of symbols, bars, exclamation marks, capitals, digits, punctuation and letters."""
    groups = ["#*$%&<>{}[]^~=_\\@+", "|", "!", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:?'\"()-", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    out = np.zeros((256, len(groups)))
    for k, g in enumerate(groups):
        out[list(g.encode()), k] = 1
    out[128:, 6] = 0.5  # most letters beyond ASCII take two bytes
    return out


MASKS = _class_masks()


def text_features(text: str | None) -> list[float]:
    """FEATURES of a whole text; those of a text without words are all zero but ``few_words``."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0, 1.0] + [0.0] * (len(FEATURES) - 2)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ MASKS
    size = sum(map(len, words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    distinct = len(set(words))
    trigrams = len(set(zip(words, words[1:], words[2:]))) if n > 2 else 0
    share = counts / size
    per_word = np.minimum(1.0, counts[:3] / n)
    return [float(np.log1p(n)), 1 / n, float(per_word[0]), float(per_word[1]), float(per_word[2]), *np.minimum(1.0, share[3:7]).tolist(), size / n, sum(len(w) > 20 for w in words) / n, distinct / n, min(1.0, 3 * (1 - distinct / n) ** 4), 1 - len(set(lines)) / len(lines), len(lines) / n, 1 - trigrams / max(1, n - 2) if n > 2 else 0.0]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def features_of(text: pd.Series) -> pd.Series:
    return pd.Series([text_features(t) for t in text], dtype=object)


def pairs(good: int, bad: int, opponents: int) -> tuple[np.ndarray, np.ndarray]:
    """Every document of the larger class against ``opponents`` of the other, by a fixed stride."""
    n = max(good, bad)
    k = np.arange(n * opponents)
    first, meets = k % n, (k % n + (k // n) * 7919 + k // n) % min(good, bad)
    return (first, meets) if good >= bad else (meets, first)


def fit_bradley_terry(x: np.ndarray, label: np.ndarray, opponents: int = 4, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Newton's method on the mean logistic loss of the differences, features scaled by their spread."""
    spread = x.std(axis=0) + 1e-9
    good, bad = x[label == 1] / spread, x[label == 0] / spread
    if not len(good) or not len(bad):
        return np.zeros(x.shape[1])
    a, b = pairs(len(good), len(bad), opponents)
    d = good[a] - bad[b]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -50, 50)))  # probability of the wrong order
        g = -(d * p[:, None]).mean(axis=0) + ridge * w
        h = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w / spread


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, threshold: float = 0.7, max_per_class: int = 5000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, held_out, score (0..1), predicted of every row of ``docs``.

    Rows held out by crc32 of the id are not trained on. The score is a logistic function of the Bradley-Terry
    score, moved so that the quantile gets ``threshold``. Null and empty texts are scored like any other, by their
    features; ties score alike; labels other than 0 and 1 are ignored; without labels of both classes all score ``threshold``.
    """
    text_batches(docs.sparkSession)
    known = labels.where(~held_out(F.col(id_col), folds, fold) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    rows = stage(docs.select(F.col(id_col).alias("id"), features_of(F.col(text_col)).alias("x")), "features")
    picked = [known.where(F.col("label") == c).distinct().orderBy(md5_unit("quality:", F.col("id")), "id").limit(max_per_class) for c in (0, 1)]
    found = rows.join(F.broadcast(stage(picked[0].unionAll(picked[1]), "picked")), "id")
    sample = found.groupBy("id", "label").agg(F.min("x").alias("x")).orderBy("id", "label").select("x", "label").toPandas()  # one row for each sampled id
    x = np.array(sample["x"].tolist()).reshape(len(sample), len(FEATURES))
    w = fit_bradley_terry(x, sample["label"].to_numpy())
    raw = F.lit(0.0)
    for k, c in enumerate(w.tolist()):
        raw = raw + F.get("x", F.lit(k)) * F.lit(c)
    rows = rows.select("id", raw.alias("raw"))
    judged = rows.join(known, "id").agg(F.avg(1.0 - F.col("label")).alias("bad"), F.percentile_approx("raw", F.array(*[F.lit(q / 1000) for q in range(1001)]), 10_000).alias("q")).first()
    cut = judged["q"][round(judged["bad"] * 1000)] if judged["q"] else 0.0
    score = 1 / (1 + F.exp(-(F.col("raw") - F.lit(cut)))) if np.any(w) else F.lit(0.5)
    # An odds factor moves 0.5 to the threshold and keeps the order.
    odds = threshold / (1 - threshold)
    score = F.lit(odds) * score / (1 - score + F.lit(odds) * score)
    scored = rows.select(F.col("id").alias(id_col), held_out(F.col("id"), folds, fold).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
