"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies.

Words are lower-cased runs of ASCII letters and digits (inner dots, hyphens
and apostrophes included); a shingle is five words. A template matches a
document if one window of the document holds at least ``PERCENT`` % of the
template's shingles. Templates of similar length form a class; its windows are
as long as the longest template of the class plus a stride of a quarter of
that, so whatever place a copy has, a window holds it whole.

Each window has ``bands`` min-hashes, one row per band. The class's number of
bands is such that a window that matches shares a band with the template with
probability 1 - ``MISS`` at least: it follows from the smallest Jaccard
similarity that a matching window can have with a template of the class.

Only windows that share a shingle with some template of their class are
hashed: two sets without a common element cannot share a min-hash, so this
drops no candidate. Only DataFrame functions; the template tables are as long
as the list of templates.

Defined results: a text that is null or has fewer than five words matches
nothing; rows that share id and text count once; ties of windows go to the
first; templates of fewer than five words are refused; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import let, written

SHINGLE_WORDS = 5
PERCENT = 80
MISS = 1e-9
CLASS_RATIO = 1.25  # longest to shortest template of a class
WORD = r"[a-z0-9]+(?:[.'-][a-z0-9]+)*"

# Published license notices.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "BSD conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                      "provided that the following conditions are met",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
    "MIT notice": "Released under the MIT License.",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the Software), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software",
}


@dataclass(frozen=True)
class WindowClass:
    number: int
    names: tuple[str, ...]
    shingles: int  # of a window
    stride: int
    bands: int


def needed(words: int) -> int:
    """Shingles of a template of so many words that a match must hold."""
    return -(-(words - SHINGLE_WORDS + 1) * PERCENT // 100)


def window_classes(templates: dict[str, str]) -> list[WindowClass]:
    """Classes of templates by length, with windows and bands for each."""
    length = {name: len(re.findall(WORD, text.lower())) for name, text in templates.items()}
    if short := [name for name, n in length.items() if n < SHINGLE_WORDS]:
        raise ValueError(f"templates of fewer than {SHINGLE_WORDS} words: {short}")
    left, out = sorted(length, key=lambda x: (-length[x], x)), []
    while left:
        longest = length[left[0]]
        own = [x for x in left if length[x] * CLASS_RATIO >= longest]
        left = [x for x in left if x not in own]
        stride = max(1, longest // 4)
        window = longest + stride - SHINGLE_WORDS
        # the least similar match: a window full of other shingles but for those that the template needs
        alike = min(needed(length[x]) / (window + length[x] - SHINGLE_WORDS + 1 - needed(length[x])) for x in own)
        bands = 1 if alike >= 1 else math.ceil(math.log(MISS) / math.log(1 - alike))
        out.append(WindowClass(len(out), tuple(own), window, stride, bands))
    return out


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)


def shingles(found: Column) -> Column:
    """Hashes of the five-word shingles of an array of words, in order."""
    places = F.sequence(F.lit(0), F.size(found) - SHINGLE_WORDS)
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(SHINGLE_WORDS)]))
    return F.when(F.size(found) >= SHINGLE_WORDS, hashes).otherwise(F.array().cast("array<bigint>"))


def bands(window: Column, number: Column) -> Column:
    """The min-hash of the window in each band."""
    return let(window, lambda own: F.transform(F.sequence(F.lit(0), number - 1), lambda j: F.array_min(F.transform(
        own, lambda h: F.xxhash64(h, j)))))


def template_table(spark: SparkSession, templates: dict[str, str], classes: list[WindowClass]) -> DataFrame:
    rows = [(c.number, name, templates[name], c.bands) for c in classes for name in c.names]
    table = spark.createDataFrame(rows, "class int, license string, template string, bands int")
    parts = table.withColumn("template_set", F.array_distinct(let(words(F.col("template")), shingles)))
    need = F.ceil(F.size("template_set") * PERCENT / 100).cast("int")
    return parts.select("class", "license", "template_set", need.alias("need"), "bands")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document and template found: doc_id, license, n_windows, start_word, shared, containment."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    classes = window_classes(templates)
    table = template_table(spark, templates, classes)
    sets = {c.number: set() for c in classes}
    for row in table.select("class", "template_set").collect():  # the templates
        sets[row["class"]].update(row["template_set"])

    def literal(values: set[int]) -> Column:
        return F.array(*[F.lit(x).cast("bigint") for x in sorted(values)])

    found = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        let(words(F.col(text_col)), shingles).alias("s"))
    near = written(found.filter(F.arrays_overlap("s", literal(set().union(*sets.values())))), "license_candidates")

    def windows(c: WindowClass) -> Column:
        last = F.ceil(F.greatest(F.size("s") - c.shingles, F.lit(0)) / c.stride).cast("int")
        every = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(
            F.lit(c.number).alias("class"), F.lit(c.bands).alias("bands"), (k * c.stride).alias("start"),
            F.slice("s", k * c.stride + 1, c.shingles).alias("window")))
        return F.filter(every, lambda w: F.arrays_overlap(w["window"], literal(sets[c.number])))

    cut = near.select("doc_id", "text_hash", F.explode(F.flatten(F.array(*[windows(c) for c in classes]))).alias("w"))
    hashed = cut.select("doc_id", "text_hash", "w.class", "w.start", "w.window",
                        F.posexplode(bands(F.col("w.window"), F.col("w.bands"))).alias("band", "value"))
    keys = table.select("license", "class", "need", "template_set", F.posexplode(
        bands(F.col("template_set"), F.col("bands"))).alias("band", "value"))
    candidates = hashed.join(keys, ["class", "band", "value"])
    shared = F.size(F.array_intersect("window", "template_set"))
    matches = candidates.withColumn("shared", shared).filter(F.col("shared") >= F.col("need")).select(
        "doc_id", "text_hash", "license", "start", "shared", F.size("template_set").alias("of")).distinct()
    best = F.max(F.struct("shared", (-F.col("start")).alias("back"))).alias("best")
    return matches.groupBy("doc_id", "text_hash", "license").agg(
        F.count(F.lit(1)).alias("n_windows"), best, F.max("of").alias("of")).select(
        "doc_id", "license", "n_windows", (-F.col("best.back")).cast("long").alias("start_word"),
        F.col("best.shared").cast("long").alias("shared"), (F.col("best.shared") / F.col("of")).alias("containment"))


def oracle_sql(templates: dict[str, str] | None = None) -> str:
    """The same result by brute force over all windows, in DuckDB."""
    templates = TEMPLATES if templates is None else templates
    word = WORD.replace("'", "''")

    def grams(x: str) -> str:
        return f"[array_to_string({x}[i:i+{SHINGLE_WORDS - 1}], ' ') FOR i IN range(1, len({x}) - {SHINGLE_WORDS - 2})]"

    rows = ", ".join("({}, {}, {}, '{}', '{}')".format(c.number, c.shingles, c.stride, name.replace("'", "''"),
                                                       templates[name].replace("'", "''"))
                     for c in window_classes(templates) for name in c.names)
    return f"""
WITH t0 AS (SELECT *, regexp_extract_all(lower(template), '{word}') AS w FROM (VALUES {rows}) v(class, win, stride, license, template)),
t AS (SELECT class, win, stride, license, list_distinct({grams('w')}) AS ts FROM t0),
d0 AS (SELECT DISTINCT doc_id, text, regexp_extract_all(lower(text), '{word}') AS w FROM documents WHERE text IS NOT NULL),
d AS (SELECT doc_id, text, {grams('w')} AS s FROM d0 WHERE len(w) >= {SHINGLE_WORDS}),
p AS (SELECT d.doc_id, d.text, d.s, t.* FROM d JOIN t ON list_has_any(d.s, t.ts)),
x AS (SELECT doc_id, text, license, ts, s, win, k * stride AS start FROM p,
      LATERAL (SELECT unnest(range(0, CAST(ceil(greatest(len(s) - win, 0) / stride) AS BIGINT) + 1)) AS k)),
m AS (SELECT doc_id, text, license, start, len(ts) AS n, len(list_intersect(list_distinct(s[start+1:start+win]), ts)) AS shared FROM x),
h AS (SELECT * FROM m WHERE shared >= CAST(ceil(n * {PERCENT} / 100) AS BIGINT))
SELECT doc_id, license, count(*) AS n_windows, CAST(-max((shared, -start))[2] AS BIGINT) AS start_word,
       CAST(max(shared) AS BIGINT) AS shared, CAST(max(shared) AS DOUBLE) / max(n) AS containment
FROM h GROUP BY doc_id, text, license
"""
