"""License scans: which license notices a text holds, in DataFrame functions alone.

Templates and texts become sequences of five-word shingles. Overlapping windows of four shingles
(every second one of a text, every one of a template) get a MinHash signature, whose bands of one
hash each are joined. Equal windows collide with certainty, two that share one shingle of seven with
probability 1 - (6/7)^20 = 0.95. A template of up to eight shingles is retrieved by any one of its
shingles as well, and so never missed; by windows alone one of a single shingle, which lies in two
windows that share two of six shingles, would be missed with probability (2/3)^20 = 0.0003.
Retrieved templates are
verified exactly: the text must have 0.8 of their shingles. Keys come from shingles, so a text without
a single shingle of any template has no key in common with one, and its windows are not looked at.

Defined results. Null, empty or word-free text: no license. Null doc_id: kept. Repeated rows: found
once; rows that share a doc_id are told apart by their texts. A template of fewer than five words,
or null: never found. Templates with the same shingles: each is found. Empty tables: no rows.
Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.contamination import keyed, words

SHINGLE = 5
WINDOW = 4
STRIDE = 2
BANDS = 20
#: Templates of up to so many shingles are retrieved by single shingles, too.
SHORT = 2 * WINDOW
CONTAINMENT = 0.8
#: Template bands are broadcast up to this many rows (about 16 MB); beyond, they are shuffled.
BROADCAST_ROWS = 200_000
#: With up to so many template bands (no more than about as many shingles), texts that share no shingle
#: with any template are left out before windows are looked at.
PROBED_ROWS = 20_000

# Notices by which licenses are named, as their authors word them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "either version 2 of the License, or (at your option) any later version."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def templates(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({n}, '{name}', '{text}')" for n, (name, text) in enumerate(TEMPLATES))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(template_id, license, text)")


def shingles(w: str, size: int = SHINGLE) -> Column:
    """Shingles of the array column ``w``, as space-joined text; fewer words: the whole sequence."""
    parts = ", ".join(f"get({w}, i + {j})" for j in range(size))
    return F.expr(
        f"CASE WHEN size({w}) = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE "
        f"transform(sequence(0, greatest(size({w}) - {size}, 0)), i -> concat_ws(' ', {parts})) END")


def hashes(w: str, size: int = SHINGLE) -> Column:
    """Hashes of the shingles, without the shingles being written out."""
    parts = ", ".join(f"get({w}, i + {j})" for j in range(size))
    return F.expr(
        f"CASE WHEN size({w}) = 0 THEN CAST(array() AS ARRAY<BIGINT>) ELSE "
        f"transform(sequence(0, greatest(size({w}) - {size}, 0)), i -> xxhash64({parts})) END")


def band_keys(h: str, stride: int, bands: int = BANDS, window: int = WINDOW) -> Column:
    """One key per window and band: the window's smallest hash under the band's permutation,
    marked with the band. (``slice`` would copy the whole array for every window.)"""
    per_band = [
        f"transform(array(transform({h}, x -> xxhash64(x, {band}))), p -> transform(sequence(0, size(p) - 1, {stride}), "
        f"s -> (least({', '.join(f'get(p, s + {j})' for j in range(window))}) & -32L) | {band}L))[0]"
        for band in range(bands)
    ]
    return F.expr(f"CASE WHEN size({h}) = 0 THEN CAST(array() AS ARRAY<BIGINT>) ELSE array_distinct(concat({', '.join(per_band)})) END")


def shingle_keys(h: str) -> Column:
    """One key per shingle, marked with a number that no band has."""
    return F.expr(f"array_distinct(transform({h}, x -> (xxhash64(x, 31) & -32L) | 31L))")


def sharing(hashed: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``hashed(h)`` that have a shingle of any of a few templates, ``known(th)``. A key in
    common is a shingle in common: without one, nothing can be retrieved and nothing found."""
    every = known.select(F.explode("th").alias("x")).agg(F.collect_set("x").alias("every"))  # one row
    return hashed.join(F.broadcast(every), F.arrays_overlap("h", "every")).drop("every")


def find_licenses(docs: DataFrame, notices: DataFrame) -> DataFrame:
    """Notices found: doc_id, template_id, license and containment, each once per different text."""
    known = notices.select("template_id", "license", words(F.col("text")).alias("tw")).where(F.size("tw") >= SHINGLE)
    known = known.select("template_id", "license", hashes("tw").alias("th"), F.array_distinct(shingles("tw")).alias("ts"))
    keys = known.select("template_id", F.explode(F.concat(
        band_keys("th", 1), F.when(F.size("th") <= SHORT, shingle_keys("th")).otherwise(F.array().cast("array<bigint>")))).alias("key")).distinct()
    n_keys = keys.count()
    small = n_keys <= BROADCAST_ROWS
    texts = keyed(docs)
    hashed = texts.select("doc_id", "text_key", words(F.col("text")).alias("w")).select("doc_id", "text_key", hashes("w").alias("h"))
    if n_keys <= PROBED_ROWS:
        hashed = sharing(hashed, known)
    listed = hashed.select("doc_id", "text_key", F.explode(F.concat(band_keys("h", STRIDE), shingle_keys("h"))).alias("key"))
    retrieved = listed.join(F.broadcast(keys) if small else keys, "key")
    asked = retrieved.groupBy("doc_id", "text_key").agg(F.collect_set("template_id").alias("asked"))  # at most all templates
    same = F.col("t.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("t.text_key") == F.col("a.text_key"))
    parts = texts.alias("t").join(asked.alias("a"), same).select("t.doc_id", "t.text_key", words(F.col("t.text")).alias("w"), "a.asked")
    parts = parts.select("doc_id", "text_key", shingles("w").alias("s"), "asked").select("doc_id", "text_key", "s", F.explode("asked").alias("template_id"))
    checked = parts.join(F.broadcast(known) if small else known, "template_id").select(
        "doc_id", "text_key", "template_id", "license",
        (F.size(F.array_intersect("ts", "s")) / F.size("ts")).alias("containment"))
    return checked.where(F.col("containment") >= CONTAINMENT).dropDuplicates(["doc_id", "text_key", "template_id"])


def licenses(docs: DataFrame, notices: DataFrame) -> DataFrame:
    """Licenses of every text that has any: doc_id, license, the best containment and the notices."""
    return find_licenses(docs, notices).groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.count_distinct("template_id").alias("n_notices"))
