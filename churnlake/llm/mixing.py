"""Mixing sources to target weights by capped water-filling, then seeded repetitions.

The budget is shared by weight; a source that would pass its cap (``max_epochs`` times its size)
is clamped, and the excess is shared again among the rest until none is above. With L the level
(words per unit of weight) a source's target is least(cap, L * weight), so only L is sought, by a
few aggregates over the table of sources.

A source's target is a whole number of repetitions of everything plus a fraction. The fraction is
sampled without replacement: documents in the order of a seeded hash, until their words reach it.
The cut is found from a histogram of the hash (``CELLS`` cells a source), and only the one cell that holds the cut is
ordered, so a source with a third of all rows is never sorted as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.common import WORD, md5_unit, stage

CELLS = 4096
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """(source, weight): the cycle's weights over the sources by code point, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.select("source", F.get(weights, F.pmod(rank, F.lit(len(cycle)))).alias("weight"))


def water_level(sources: DataFrame, budget: float) -> float | None:
    """Words per unit of weight over (cap, weight); None if every source is at its cap."""
    level = 0.0
    while True:
        capped = F.col("cap") < F.lit(level) * F.col("weight")
        spent, open_weight = sources.agg(F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight")))).first()
        if not open_weight:
            return None
        risen = (budget - (spent or 0.0)) / open_weight
        if risen <= level:
            return level
        level = risen


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _marked(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    docs = docs.withColumn("_mx_key", _key(F.col(source_col))).withColumn("_mx_size", word_count(F.col(text_col)))
    docs = docs.withColumn("_mx_u", md5_unit(seed, F.col(id_col)))
    return docs.withColumn("_mx_cell", F.floor(F.col("_mx_u") * CELLS).cast("int"))


def source_plan(light: DataFrame, weights, share: float, max_epochs: float) -> DataFrame:
    """One row per source: size, target, whole repetitions, and the cell and words where the fraction is cut."""
    cells = stage(light.groupBy("_mx_key", "_mx_source", "_mx_cell").agg(F.sum("_mx_size").alias("words")), "cells")
    sources = cells.groupBy("_mx_key", F.col("_mx_source").alias("source")).agg(F.sum("words").alias("_mx_total"))
    sources = stage(sources, "sources")
    weighted = weights(sources.select("source")) if callable(weights) else weights
    weighted = weighted.select(_key(F.col("source")).alias("_mx_key"), F.col("weight").cast("double").alias("weight"))
    sources = stage(sources.drop("source").join(weighted, "_mx_key").withColumn("cap", F.lit(float(max_epochs)) * F.col("_mx_total")), "weighted")
    total = sources.agg(F.sum("_mx_total")).first()[0] or 0
    level = water_level(sources, share * total)
    target = F.col("cap") if level is None else F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    sources = sources.withColumn("_mx_target", target)
    whole = F.when(F.col("_mx_total") > 0, F.floor(F.col("_mx_target") / F.col("_mx_total"))).otherwise(0).cast("long")
    sources = sources.withColumn("_mx_whole", whole).withColumn("_mx_need", F.col("_mx_target") - F.col("_mx_whole") * F.col("_mx_total"))
    upto = F.sum("words").over(Window.partitionBy("_mx_key").orderBy("_mx_cell"))
    cut = cells.drop("_mx_source").withColumn("upto", upto).join(sources.select("_mx_key", "_mx_need"), "_mx_key")
    cut = cut.where((F.col("_mx_need") > 0) & (F.col("upto") >= F.col("_mx_need")))
    cut = cut.groupBy("_mx_key").agg(F.min(F.struct("_mx_cell", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
    plan = sources.join(cut, "_mx_key", "left")
    # Without a cut there is no fraction, or rounding put it past the last word: then all or none.
    last = F.when(F.col("_mx_need") >= F.col("_mx_total") * 0.5, F.lit(CELLS)).otherwise(-1)
    return stage(plan.select("_mx_key", "_mx_total", "_mx_target", "_mx_whole", "_mx_need", F.coalesce("cut._mx_cell", last).alias("_mx_cut"), F.col("cut.before").alias("_mx_before")), "plan")


def _with_copies(marked: DataFrame, plan: DataFrame, id_col: str) -> DataFrame:
    """``marked`` with ``_mx_copies``. Only the cells that hold a cut are shuffled and ordered."""
    if plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = marked.join(plan, "_mx_key")
    extra = (F.col("_mx_cell") < F.col("_mx_cut")).cast("long")
    plain = rows.where("_mx_cell <> _mx_cut").withColumn("_mx_copies", F.col("_mx_whole") + extra)
    order = Window.partitionBy("_mx_key").orderBy("_mx_u", F.col(id_col).asc_nulls_last(), "_mx_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A document is taken if that brings the words nearer to what is needed.
    middle = F.col("_mx_before") + F.sum("_mx_size").over(order) - F.col("_mx_size") / 2
    edge = rows.where("_mx_cell = _mx_cut").withColumn("_mx_copies", F.col("_mx_whole") + (middle <= F.col("_mx_need")).cast("long"))
    return plain.unionAll(edge)


def mix_plan(docs: DataFrame, weights=cyclic_weights, share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix:", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words, repeats counted).

    ``weights``: a table (source, weight) or a function from the table of sources to one; sources
    without a weight are left out of the mix. A null source is a source of its own, null text has
    size 0, repeated rows are sampled each for itself, null ids share one hash and are ordered
    last. An empty table gives an empty result. Reruns agree: the hash depends on seed and id only.
    """
    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("_mx_source"))
    light = stage(_marked(light, "id", "text", "_mx_source", seed).drop("text"), "sizes")
    rows = _with_copies(light, source_plan(light, weights, share, max_epochs), "id")
    return rows.select(F.col("id").alias(id_col), F.col("_mx_size").alias("size"), F.col("_mx_total").alias("source_size"), F.col("_mx_target").alias("target"), (F.col("_mx_size") * F.col("_mx_copies")).alias("taken"))


def mix_documents(docs: DataFrame, weights=cyclic_weights, share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix:", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_plan`` takes it (documents without words go by their source's repetitions).

    The texts are not shuffled but for the cells that hold a cut.
    """
    marked = _marked(docs, id_col, text_col, source_col, seed)
    light = stage(marked.select("_mx_key", F.col(source_col).alias("_mx_source"), "_mx_cell", "_mx_size"), "sizes")
    rows = _with_copies(marked, source_plan(light, weights, share, max_epochs), id_col)
    rows = rows.where("_mx_copies > 0").withColumn("_mx_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mx_copies"))))
    return rows.select(*docs.columns)
