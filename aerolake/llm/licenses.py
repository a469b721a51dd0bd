"""License scans, in DataFrame operations only.

Texts and license templates become sets of five-word shingles of lower-case words. For each length
of a template, overlapping windows of that many shingles are taken from every text, at steps of an
eighth of it. MinHash bands of windows and templates retrieve candidates, and the shingles of the
whole text decide: a match holds at least 80 % of the template's shingles, in one place or in many.

A band is one MinHash. If a text holds 80 % of the n shingles of a template, a band retrieves it
with a probability of at least 0.4: some shingle of the text is smallest of the template and of the
at most n other shingles in a window that holds it. So the number of bands follows from ``recall``,
however the notice is scattered. A window can only collide if one of its shingles is a smallest of
a template; windows without any of those few are left out, which drops no candidate.

Defined results: null and empty texts match nothing; a template of fewer than five words is one
shingle of all its words and needs a text of those words alone; repeated rows are scanned each,
one result row for each. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.plans.tables import stage

# Well-known license notices.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "Apache-2.0-notice": [
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied."
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3"],
    "GPL-notice": [
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation"
    ],
    "MIT": ["Released under the MIT License"],
    "MIT-notice": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction"
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}
SHINGLE = 5
CONTAINMENT = 0.8
_GAP = "[^\\p{L}\\p{N}]+"
_WORD = re.compile(r"[^\W_]+")


def template_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def band_count(recall: float) -> int:
    """Bands of one MinHash that retrieve a match with at least this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - CONTAINMENT / 2))


def _shingles(words: Column) -> Column:
    """Hashes of five words in a row; of all words where there are fewer."""
    long = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, SHINGLE)]),
    )
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(F.size(words) >= SHINGLE, long).when(F.size(words) > 0, short)


def shingled(texts: DataFrame, *keep: str) -> DataFrame:
    """``keep``, a row number ``_row`` and the shingle hashes of ``text`` in order.

    The row number also keeps filters on the shingles above this projection: pushed below, they
    would split the text again for each word.
    """
    lower = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    words = texts.select(*keep, F.array_remove(F.split(lower, _GAP), "").alias("words"))
    return words.select(
        *keep,
        F.monotonically_increasing_id().alias("_row"),
        _shingles(F.col("words")).alias("shingles"),
    )


def _constants(count: int) -> list[int]:
    """Signed 64-bit constants from a fixed linear congruential sequence.

    The smallest of hash XOR constant is a MinHash.
    """
    value, out = 88172645463325252, []
    for _ in range(count):
        value = (value * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(value - 2**63)
    return out


def _smallest(window: Column, constant: int) -> Column:
    """The smallest shingle of a window after XOR with a constant."""
    return F.array_min(F.transform(window, lambda h: h.bitwiseXOR(F.lit(constant))))


def templates_table(spark: SparkSession, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """license, template, shingles (distinct) and size: a fixed small table."""
    rows = [
        (name, number, " ".join(template_words(text)))
        for name, texts in sorted((templates or TEMPLATES).items())
        for number, text in enumerate(texts)
    ]
    frame = spark.createDataFrame(rows, "license string, template int, text string")
    made = shingled(frame, "license", "template")
    return made.select(
        "license", "template", F.array_distinct("shingles").alias("shingles")
    ).withColumn("size", F.size("shingles"))


def _bands(size: Column, window: Column, bands: int) -> Column:
    return F.array(
        *[F.xxhash64(size, F.lit(i), _smallest(window, c)) for i, c in enumerate(_constants(bands))]
    )


def _windows(shingles: Column, sizes: list[int], marked: Column) -> Column:
    """Array of (size, at, window) for the given sizes, of windows with a marked shingle."""

    def of_size(size: Column) -> Column:
        last = F.greatest(F.size(shingles) - size + 1, F.lit(1))
        steps = F.sequence(F.lit(1), last, F.greatest(F.floor(size / 8).cast("int"), F.lit(1)))
        return F.transform(  # the last window ends with the text
            F.array_union(steps, F.array(last)),
            lambda at: F.struct(size.alias("size"), at.alias("at"), F.slice(shingles, at, size).alias("window")),
        )

    made = F.flatten(F.transform(F.array(*[F.lit(s) for s in sizes]), of_size))
    return F.filter(made, lambda w: F.arrays_overlap(w["window"], marked))


def scan(
    docs: DataFrame, templates: dict[str, list[str]] | None = None, recall: float = 0.999999
) -> DataFrame:
    """doc_id, license, containment and first_shingle of every match of every text.

    ``containment`` is that of the best of a license's templates, ``first_shingle`` the place of
    the first window that retrieved one.
    """
    spark = docs.sparkSession
    known = templates_table(spark, templates).collect()  # fixed and small
    if not known:
        return spark.createDataFrame([], "doc_id bigint, license string, containment double, first_shingle int")
    bands = band_count(recall)
    texts = shingled(docs.select("doc_id", "text"), "doc_id")
    # shingles that are a smallest hash of some template
    marks = {min(row["shingles"], key=lambda h: h ^ c) for row in known for c in _constants(bands)}
    marked = F.array(*[F.lit(m) for m in sorted(marks)])
    near = stage(
        texts.filter(F.coalesce(F.arrays_overlap("shingles", marked), F.lit(False))), "licenses"
    )
    sizes = sorted({row["size"] for row in known})
    windows = near.select("_row", F.explode(_windows(F.col("shingles"), sizes, marked)).alias("w"))
    keyed = windows.select(
        "_row", "w.at", F.explode(_bands(F.col("w.size"), F.col("w.window"), bands)).alias("band")
    )
    wanted = spark.createDataFrame(
        [(r["license"], r["template"], r["size"], r["shingles"]) for r in known],
        "license string, template int, size int, wanted array<bigint>",
    )
    keys = wanted.select(
        "license", "template", F.explode(_bands(F.col("size"), F.col("wanted"), bands)).alias("band")
    )
    retrieved = (
        keyed.join(F.broadcast(keys), "band")  # templates times bands
        .groupBy("_row", "license", "template")
        .agg(F.min("at").alias("first_shingle"))
    )
    held = (
        near.join(retrieved, "_row")
        .join(F.broadcast(wanted), ["license", "template"])  # templates
        .withColumn("containment", F.size(F.array_intersect("wanted", "shingles")) / F.size("wanted"))
        .filter(F.col("containment") >= CONTAINMENT)
    )
    return (
        held.groupBy("_row", "license")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("containment").alias("containment"),
            F.min("first_shingle").alias("first_shingle"),
        )
        .select("doc_id", "license", "containment", "first_shingle")
    )
