"""License scan with DataFrame functions only.

Templates and documents are sequences of lower-case words, compared by 5-word shingles.  Overlapping
windows of several lengths get a MinHash signature; windows of a template and of a document that share
a band propose the template, and the share of its shingles in the document decides.

A window without any shingle of a template has no minimum in common with one, so only windows around
such shingles are hashed; nothing is lost by that.  Template tables are small by construction and the
only ones that are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import let, written

SHINGLE, CONTAINMENT = 5, 0.75
TOKEN = r"[\p{L}\p{N}]+"
#: Window lengths in shingles; a template uses the longest that fits, at every position of it.
LENGTHS = (1, 2, 4, 8, 16, 32, 64)
#: Windows of Jaccard similarity 0.5 share a band with probability 1 - (1 - 0.5 ** ROWS) ** BANDS = 0.99.
BANDS, ROWS = 16, 2

# Notices and passages of public licenses.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "This project is licensed under the MIT License",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
    "warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def templates(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """license, text of the templates as an inline table."""
    rows = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in (texts or TEMPLATES).items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(license, text)")


def shingles(text: Column) -> Column:
    """Hashes of the 5-word shingles at each place; none for fewer words."""

    def of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - SHINGLE)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))

    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return let(words, lambda w: F.when(F.size(w) >= SHINGLE, of(w)).otherwise(F.array().cast("array<bigint>")))


def _keys(windows: DataFrame) -> DataFrame:
    """Band keys of windows (length, part: their shingles), one row a band."""
    seeds = F.sequence(F.lit(1), F.lit(BANDS * ROWS))
    least = F.transform(seeds, lambda j: F.array_min(F.transform(F.array_distinct("part"), lambda x: F.xxhash64(x, j))))
    w = windows.withColumn("_least", F.explode(F.array(least)))
    keys = [F.xxhash64(F.col("length"), F.lit(b), *[F.get("_least", F.lit(ROWS * b + r)) for r in range(ROWS)]) for b in range(BANDS)]
    return w.select(*[c for c in windows.columns if c != "part"], F.explode(F.array(*keys)).alias("key"))


def scan(docs: DataFrame, texts: dict[str, str] | None = None) -> DataFrame:
    """One row for each document (doc_id, text; other columns are ignored) and template of which it
    holds three quarters of the shingles or more: doc_id, license, template_shingles, containment,
    first_word and last_word (of the shingles found).  Templates need five words.  Null texts and texts
    of fewer words have no row; repeated rows have theirs each."""
    spark = docs.sparkSession
    t = templates(spark, texts).select("license", shingles(F.col("text")).alias("h")).where(F.size("h") > 0)
    t = written(t.withColumn("own", F.array_distinct("h")), "license-templates")
    wanted = sorted({x for r in t.select("own").collect() for x in r["own"]})
    one = F.expr(f"array({','.join(f'{x}L' for x in wanted) or '0L'})")
    rows = docs.select("doc_id", F.explode(F.array(shingles(F.coalesce(F.col("text"), F.lit(""))))).alias("h"))
    held = rows.withColumn("own", F.explode(F.array(F.array_intersect("h", one)))).where(F.size("own") > 0)
    held = held.withColumn("places", F.filter(F.transform("h", lambda x, i: F.when(F.array_contains("own", x), i)), lambda i: i.isNotNull()))
    held = written(held.withColumn("_row", F.monotonically_increasing_id()), "license-rows")

    lengths = F.explode(F.array(*[F.lit(n) for n in LENGTHS])).alias("length")
    longest = F.lit(max(LENGTHS))
    fits = F.array_max(F.filter(F.array(*[F.lit(n) for n in LENGTHS]), lambda n: n <= F.least(F.size("h"), longest)))
    t_windows = t.withColumn("length", fits).select("license", "length", "h", F.explode(F.sequence(F.lit(0), F.size("h") - F.col("length"))).alias("s"))
    t_keys = _keys(t_windows.select("license", "length", F.slice("h", F.col("s") + 1, F.col("length")).alias("part"))).distinct()
    # windows of the document that hold a template's shingle, a quarter of their length apart
    step = F.greatest(F.col("length") / 4, F.lit(1)).cast("int")
    first = lambda p: F.greatest(F.ceil((p - F.col("length") + 1) / F.col("step")).cast("int"), F.lit(0))
    begins = F.array_distinct(F.flatten(F.transform("places", lambda p: F.transform(F.sequence(first(p), F.greatest(first(p), F.floor(p / F.col("step")).cast("int"))), lambda k: k * F.col("step")))))
    d_windows = held.select("_row", "h", "places", lengths).withColumn("step", step).select("_row", "h", "length", F.explode(begins).alias("s"))
    d_keys = _keys(d_windows.where(F.col("s") < F.size("h")).select("_row", "length", F.slice("h", F.col("s") + 1, F.col("length")).alias("part")))
    # bound of the broadcasts: the templates and the windows of each
    found = d_keys.join(F.broadcast(t_keys), ["length", "key"]).select("_row", "license").distinct()
    pairs = found.join(F.broadcast(t.select("license", F.col("own").alias("_t"))), "license").join(held, "_row")
    share = F.size(F.array_intersect("_t", "own")) / F.size("_t")
    at = F.filter("places", lambda p: F.array_contains("_t", F.get("h", p)))
    out = pairs.select("doc_id", "license", F.size("_t").cast("long").alias("template_shingles"), share.alias("containment"), at.alias("_at")).where(F.col("containment") >= CONTAINMENT)
    return out.select("doc_id", "license", "template_shingles", "containment", F.array_min("_at").cast("long").alias("first_word"), (F.array_max("_at") + SHINGLE - 1).cast("long").alias("last_word"))


def oracle() -> str:
    """The same result by joining all shingles as text."""
    rows = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in TEMPLATES.items())
    cut = f"list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: struct_pack(p := i - 1, s := array_to_string(w[i:i + {SHINGLE - 1}], ' ')))"
    words = f"regexp_extract_all(lower(text), '{TOKEN}')"
    return f"""
WITH t AS (SELECT * FROM (VALUES {rows}) AS v(license, text)),
tw AS (SELECT license, {words} AS w FROM t),
ts AS (SELECT DISTINCT license, u.s AS s FROM (SELECT license, unnest({cut}) AS u FROM tw)),
tn AS (SELECT license, count(*) AS template_shingles FROM ts GROUP BY ALL),
dw AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT r, doc_id, u.p AS p, u.s AS s FROM (SELECT r, doc_id, unnest({cut}) AS u FROM dw)),
m AS (SELECT r, doc_id, license, count(DISTINCT ds.s) AS n, min(p) AS first_word, max(p) + {SHINGLE - 1} AS last_word FROM ds JOIN ts ON ds.s = ts.s GROUP BY ALL)
SELECT doc_id, license, template_shingles, n / template_shingles AS containment, first_word, last_word
FROM m JOIN tn USING (license) WHERE n / template_shingles >= {CONTAINMENT}"""
