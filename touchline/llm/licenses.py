"""License notices in documents, in DataFrame operations only.

A template is the text of a notice.  Words are runs of letters and digits in
lower case, shingles are ``SHINGLE`` words.  A document is read in windows of
twice the longest template's words that overlap by half, so a notice always
lies whole in one of them.  Each window's shingles that occur in any template
are MinHashed into bands; a band shared with a template retrieves it, and the
template is reported if the window holds at least ``CONTAINED`` of its
shingles exactly.

Shingles of no template don't enter a window's set: they can't change what it
holds of one.  The number of bands follows from the similarity of such sets
that should be found (``SIMILAR``, a notice beside three times as many
shingles of other notices) and the chance of finding it (``CHANCE``).

The templates are a parameter; their shingles (some hundreds) are constants of
the plan and their bands a broadcast of one row a template and band.

Defined cases: null and empty texts hold nothing; a template of fewer words
than a shingle is refused; rows with one doc_id give one row a license; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, text_or_empty

SHINGLE = 3
CONTAINED = 0.8
SIMILAR = 0.25
CHANCE = 0.9999
ROWS = 1

#: notices as their licenses word them (fixed values)
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def bands_for(similar: float = SIMILAR, chance: float = CHANCE, rows: int = ROWS) -> int:
    """Bands of ``rows`` values that share one with this chance."""
    return math.ceil(math.log(1 - chance) / math.log(1 - similar**rows))


def words_of(text):
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles_at(text):
    """(at, hash) of every shingle of a text.  The words are bound once, as
    the element of an array, or each shingle would split the text again."""

    def of(words):
        hashed = F.transform(words, lambda w, i: F.struct(i.alias("at"), F.xxhash64(w, *[F.get(words, i + j) for j in range(1, SHINGLE)]).alias("hash")))
        return F.slice(hashed, F.lit(1), F.greatest(F.size(words) - SHINGLE + 1, F.lit(0)))

    return F.flatten(F.transform(F.array(words_of(text)), of))


def band_values(shingles, bands: int, rows: int):
    """One hash a band: of its number and the minima of its rows."""
    least = lambda n: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(n))))
    return F.array(*[F.xxhash64(F.lit(b), *[least(b * rows + r) for r in range(rows)]) for b in range(bands)])


def scan(docs: DataFrame, templates=TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """doc_id, license, containment, first_word, n_windows."""
    spark = docs.sparkSession
    if any(len(re.findall(r"[^\W_]+", t)) < SHINGLE for _, t in templates):
        raise ValueError(f"a template needs at least {SHINGLE} words")
    bands = bands_for()
    known = (
        spark.createDataFrame(list(templates), "license string, notice string")
        .withColumn("shingles", F.array_distinct(F.transform(shingles_at(F.col("notice")), lambda x: x["hash"])))
    )
    rows = known.select("license", "shingles", F.size(words_of(F.col("notice"))).alias("n")).collect()  # a row a template
    stride = max(r["n"] for r in rows)
    window = 2 * stride
    every = sorted({h for r in rows for h in r["shingles"]})
    wanted = known.select("license", F.col("shingles").alias("notice_set"), F.explode(band_values(F.col("shingles"), bands, ROWS)).alias("band"))

    # the row number keeps Spark from pushing the filter below the projection,
    # which would compute the hits twice
    hits = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.filter(shingles_at(text_or_empty()), lambda x: x["hash"].isin(every)).alias("hits"),
    ).where(F.size("hits") > 0)
    # a window starts at every multiple of the stride
    first = lambda at: F.greatest(F.lit(0), F.ceil((at + SHINGLE - window) / stride)).cast("int")
    last = lambda at: F.floor(at / stride).cast("int")
    windows = hits.select(
        "doc_id", "hits", F.explode(F.array_distinct(F.flatten(F.transform("hits", lambda x: F.sequence(first(x["at"]), last(x["at"])))))).alias("window")
    ).select(
        "doc_id",
        "window",
        F.filter("hits", lambda x: (x["at"] >= F.col("window") * stride) & (x["at"] + SHINGLE <= F.col("window") * stride + window)).alias("hits"),
    )
    sets = windows.select("doc_id", "window", "hits", F.array_distinct(F.transform("hits", lambda x: x["hash"])).alias("window_set"))
    banded = sets.select("doc_id", "window", "hits", "window_set", F.explode(band_values(F.col("window_set"), bands, ROWS)).alias("band"))
    found = banded.join(F.broadcast(wanted), "band").drop("band").distinct()
    held = F.size(F.array_intersect("window_set", "notice_set"))
    place = F.array_min(F.transform(F.filter("hits", lambda x: F.array_contains(F.col("notice_set"), x["hash"])), lambda x: x["at"]))
    return (
        found.where(held >= F.lit(contained) * F.size("notice_set"))
        .groupBy("doc_id", "license")
        .agg(
            F.max(held / F.size("notice_set")).alias("containment"),
            F.min(place).cast("long").alias("first_word"),
            F.count("*").alias("n_windows"),
        )
    )


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """The license notices of every document."""
    return scan(table(spark, sf_dir, "documents"))
