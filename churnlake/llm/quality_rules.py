"""Quality rules as weak supervision. DataFrame functions only.

Each rule votes good (1), bad (0) or abstains (null). Expectation-maximisation over the table of
vote patterns (at most 3 ** rules rows, counted by one grouped aggregate) estimates how often each
rule votes good, bad or not at all on good and on bad documents; the posterior probability of being good then
replaces all-must-pass filtering.

The word-window counts work inside the row: the windows' hashes are sorted with their places, so
that equal ones are neighbours, and the places found are merged into covered words. n log n per
text, no shuffle of words.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import WORD, let, stage

WINDOW = 3
SYMBOLS = "[#*$%&|<>]"


def repeated_window_words(words: Column) -> Column:
    """Words that lie in a window of three found twice or more in the text, first occurrences included."""

    def covered(hashes: Column) -> Column:
        paired = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(paired, marked))

    def marked(s: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            before = (k > 0) & F.get(s, F.greatest(k - 1, F.lit(0)))["h"].eqNullSafe(x["h"])
            return before | F.get(s, k + 1)["h"].eqNullSafe(x["h"])

        places = F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))
        return let(places, merged)

    def merged(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(windows, covered)).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and counts over the whole text. Null and empty texts count zero everywhere."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spread = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id",
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_exclaims"),
        let(F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)), lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("lines"),
        let(
            F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), F.size(F.array_distinct(w)).cast("long").alias("n_distinct"), repeated_window_words(w).alias("n_repeat_words")),
        ).alias("words"),
    )
    return spread.select("id", "words.*", "lines.*", "n_symbols", "n_capitals", "n_exclaims")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Votes over ``measures``: 1 good, 0 bad, null abstains. Texts without words get a vote on their length only."""
    n, chars = F.col("n_words"), F.col("word_chars")

    def vote(bad: Column, good: Column | None = None) -> Column:
        found = F.when((n > 0) & bad, F.lit(0))
        return found if good is None else found.when((n > 0) & good, F.lit(1))

    calm = (F.col("n_symbols") < 0.005 * chars) & (F.col("n_exclaims") < 0.02 * n) & (F.col("n_capitals") < 0.1 * chars)
    return {
        "symbol_chars": vote(F.col("n_symbols") > 0.03 * chars),
        "symbol_words": vote(F.col("n_symbols") > 0.2 * n),
        "capitals": vote(F.col("n_capitals") > 0.3 * chars),
        "exclaims": vote(F.col("n_exclaims") > 0.1 * n),
        "dup_lines": vote(F.col("n_dup_lines") > 0.2 * F.col("n_lines"), (F.col("n_lines") > 2) & (F.col("n_dup_lines") == 0)),
        "repeats": vote(F.col("n_repeat_words") > 0.3 * n),
        "variety": vote((F.col("n_distinct") < 0.3 * n) & (n <= 2000), (F.col("n_distinct") > 0.45 * n) & (n >= 50)),
        "length": F.when(n < 50, F.lit(0)),
        "word_length": vote(((chars < 2.5 * n) | (chars > 15 * n))),
        "calm": vote(F.lit(False), calm & (n >= 50)),
    }


@dataclass(frozen=True)
class LabelModel:
    """P(good) and, by class (1 good, 0 bad), rule and vote (1, 0, None), the probability of that vote."""

    prior: float
    votes: dict[tuple[int, str, int | None], float]

    def posterior(self) -> Column:
        """P(good | votes) over columns named after the rules."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for k in dict.fromkeys(k for _, k, _ in self.votes):
            llr = {v: math.log(self.votes[1, k, v] / self.votes[0, k, v]) for v in (1, 0, None)}
            odds = odds + F.when(F.col(k) == 1, F.lit(llr[1])).when(F.col(k) == 0, F.lit(llr[0])).otherwise(F.lit(llr[None]))
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, names: list[str], rounds: int = 50, tolerance: float = 1e-6) -> LabelModel:
    """EM over (votes, n). Each round is one aggregate over the pattern table; its sums are the next parameters.

    The first posterior takes documents with a bad vote as bad with 0.95, others as good with 0.95. Half a document of
    smoothing keeps every probability inside (0, 1). A rule is never taken to vote bad more often on good documents than on bad ones.
    """
    any_bad = functools.reduce(lambda a, b: a | b, [F.coalesce(F.col(k) == 0, F.lit(False)) for k in names])
    q, model = F.when(any_bad, F.lit(0.05)).otherwise(0.95), None
    for _ in range(rounds):
        weighted = patterns.withColumn("w1", q * F.col("n")).withColumn("w0", F.col("n") - F.col("w1"))
        sums = [F.sum(f"w{c}").alias(f"w{c}") for c in (0, 1)]
        sums += [F.sum(F.when(F.col(k) == v, F.col(f"w{c}"))).alias(f"w{c}_{k}_{v}") for c in (0, 1) for k in names for v in (0, 1)]
        got = {k: v or 0.0 for k, v in weighted.agg(*sums).first().asDict().items()}
        share = {(c, k, v): (got[f"w{c}_{k}_{v}"] + 0.5) / (got[f"w{c}"] + 1.5) for c in (0, 1) for k in names for v in (0, 1)}
        for k in names:
            share[1, k, 0] = min(share[1, k, 0], share[0, k, 0])
            share[0, k, 1] = min(share[0, k, 1], share[1, k, 1])
            for c in (0, 1):
                share[c, k, None] = max(1 - share[c, k, 0] - share[c, k, 1], 1e-9)
        new = LabelModel((got["w1"] + 0.5) / (got["w0"] + got["w1"] + 1.0), share)
        still = model and max(abs(new.prior - model.prior), *(abs(p - model.votes[x]) for x, p in share.items())) < tolerance
        model, q = new, new.posterior()
        if still:
            break
    return model


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per input row: id, the counts, base_failed, p_good, kept.

    Null and empty texts have no words, fail the base and are not kept. Repeated rows count each. Only
    id and text are read. An empty table gives an empty result.
    """
    votes = rules()
    rows = stage(measures(docs, id_col, text_col).withColumns(votes), "votes")
    patterns = stage(rows.groupBy(*votes).agg(F.count(F.lit(1)).cast("double").alias("n")).coalesce(1), "patterns")
    p = estimate(patterns, list(votes)).posterior()
    rows = rows.withColumn("p_good", p).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
    return rows.withColumnRenamed("id", id_col)
