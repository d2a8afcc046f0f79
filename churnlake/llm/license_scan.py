"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies. DataFrame functions only.

A template of s five-word shingles is sought in windows of s + stride shingles that start every ``stride`` = ceil(s / 4)
shingles, so every run of s shingles lies in some window. A window that holds 0.8 of the template has a Jaccard
similarity of at least 0.5 with it; with two hashes a band and 64 bands the chance that
no band agrees is at most (1 - 0.5 ** 2) ** 64 = 1e-8.

A band can agree only if window and template share a shingle, so windows are laid only around shingles that some
template has. That test loses nothing; it keeps the signatures from being computed for all other text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import let, stage

SHINGLE, BANDS, ROWS, LEAST = 5, 64, 2, 0.8

# Short public notices of common licences.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd-header": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """The different five-word shingles of an array of at least five words."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))


def band_keys(shingles: Column) -> Column:
    """One key per band: the band's number with ROWS MinHash values."""

    def least(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1)), lambda k: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, k))))

    def keys(signature: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, *[F.get(signature, b * ROWS + r) for r in range(ROWS)]))

    return let(F.transform(shingles, lambda s: F.xxhash64(s)), lambda h: let(least(h), keys))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, s, stride, shingles) per template of at least five words."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    rows = rows.select("license", words_of(F.col("text")).alias("w")).where(F.size("w") >= SHINGLE)
    rows = rows.select("license", shingles_of(F.col("w")).alias("t_shingles"), (F.size("w") - (SHINGLE - 1)).alias("s"))
    return rows.withColumn("stride", F.ceil(F.col("s") / 4).cast("int"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """One row per input id and licence found: id, license, containment (best window), n_windows, first_word.

    Null texts and texts of under five words hold none. Rows that share an id are reported together. Only id and text are
    read. An empty table gives an empty result; so does an empty list of templates.
    """
    spark = docs.sparkSession
    known = stage(template_table(spark, TEMPLATES if templates is None else templates), "templates")
    # The list of templates is a parameter, held in the plan: a few hundred hashes.
    hashes = [r["h"] for r in known.select(F.explode("t_shingles").alias("t")).select(F.xxhash64("t").alias("h")).distinct().collect()]
    sizes = [(r["s"], r["stride"]) for r in known.select("s", "stride").distinct().orderBy("s").collect()]
    words = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w")).where(F.size("w") >= SHINGLE)
    at = words.select("id", "w", F.explode(F.sequence(F.lit(0), F.size("w") - SHINGLE)).alias("at"))
    # concat_ws of five words is the shingle, without building an array for each
    hits = at.withColumn("h", F.xxhash64(F.concat_ws(" ", *[F.get("w", F.col("at") + k) for k in range(SHINGLE)]))).where(F.col("h").isin(hashes))
    forms = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(d).alias("stride")) for s, d in sizes])
    hits = hits.select("id", "w", "at", F.inline(forms))
    # Windows [k * stride, k * stride + s + stride) that hold the shingle.
    low = F.greatest(F.lit(0), F.floor((F.col("at") - F.col("s")) / F.col("stride")).cast("int"))
    laid = hits.select("id", "w", "s", "stride", F.explode(F.sequence(low, F.floor(F.col("at") / F.col("stride")).cast("int"))).alias("k"))
    begin = F.col("k") * F.col("stride")
    windows = laid.select("id", "s", begin.alias("first_word"), F.slice("w", begin + 1, F.col("s") + F.col("stride") + (SHINGLE - 1)).alias("w")).distinct()
    windows = windows.select("id", "s", "first_word", shingles_of(F.col("w")).alias("shingles"))
    bands = windows.withColumn("key", F.explode(band_keys(F.col("shingles"))))
    t = known.select("license", F.col("s").alias("t_s"), "t_shingles", F.explode(band_keys(F.col("t_shingles"))).alias("t_key"))
    found = bands.join(F.broadcast(t), (F.col("key") == F.col("t_key")) & (F.col("s") == F.col("t_s")))  # templates * BANDS rows
    share = F.size(F.array_intersect("shingles", "t_shingles")) / F.size("t_shingles")
    found = found.select("id", "license", "first_word", share.alias("containment")).where(F.col("containment") >= least)
    out = found.groupBy("id", "license").agg(F.max("containment").alias("containment"), F.countDistinct("first_word").alias("n_windows"), F.min("first_word").cast("long").alias("first_word"))
    return out.withColumnRenamed("id", id_col)


def oracle(templates: dict[str, str] | None = None) -> str:
    """The same result in DuckDB: exact containment in every window, without MinHash."""
    quoted = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in sorted((TEMPLATES if templates is None else templates).items()))
    words = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH t0 AS (SELECT license, {words} AS w FROM (VALUES {quoted}) v(license, text)),
t1 AS (SELECT license, len(w) - 4 AS s, CAST(ceil((len(w) - 4) / 4.0) AS BIGINT) AS stride,
         unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS sh FROM t0 WHERE len(w) >= 5),
t AS (SELECT *, count(DISTINCT sh) OVER (PARTITION BY license) AS n FROM t1),
d0 AS (SELECT doc_id, {words} AS w FROM documents),
d AS (SELECT doc_id, unnest(range(0, len(w) - 4)) AS pos, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS sh FROM d0 WHERE len(w) >= 5),
h AS (SELECT doc_id, license, n, stride, sh, pos, unnest(range(greatest(0, CAST(floor((pos - s) / stride) AS BIGINT)), CAST(floor(pos / stride) AS BIGINT) + 1)) AS k
      FROM d JOIN t USING (sh)),
c AS (SELECT doc_id, license, k * stride AS first_word, CAST(count(DISTINCT sh) AS DOUBLE) / any_value(n) AS containment FROM h GROUP BY doc_id, license, k, stride)
SELECT doc_id, license, max(containment) AS containment, count(DISTINCT first_word) AS n_windows, min(first_word) AS first_word
FROM c WHERE containment >= {LEAST} GROUP BY doc_id, license"""
