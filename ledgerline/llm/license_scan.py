"""License scans: which known license notices a text contains.

Texts are cut into overlapping windows, for every size class w of templates (w a power of two, templates of more than
w / 2 and up to w shingles): windows of 2 w shingles, each beginning w after the one before, so that every stretch as
long as a template lies in one window. A window's MinHash under BANDS functions (bands of one row) retrieves the
templates that share a value; the exact share of a template's shingles in the window, as texts, then verifies.

Shingles that no template has cannot match and are dropped before the signatures, by a join with the dictionary of
all templates' shingles. What is left of a window has 2 w shingles at most, so at the threshold 0.8 its Jaccard
similarity to a template is above 0.19 and all bands miss with a probability under 0.81 ** BANDS (3e-6 for 60);
a window that holds nothing but the notice has a similarity of 0.8 and more.

The dictionary and the template table have the size of the template list, a parameter. Defined cases: a template of
fewer than five words is refused; null, empty and shorter texts match nothing; equal rows give one result; a null
doc_id is reported as null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .benchmark_decontam import BROADCAST_DOCS, sized
from .common import Staged, read
from .shingles import SHINGLE, hits, keyed, shingle_hashes, shingle_texts, split_words

THRESHOLD = 0.8
BANDS = 60

# Notices by which licenses are named or granted.
TEMPLATES = (
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
)


def templates(spark: SparkSession, rows: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(template, license, shingles, hashes, n, class)."""
    if short := [text for _, text in rows if len(text.split()) < SHINGLE]:
        raise ValueError(f"templates need five words: {short}")
    x = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "template int, license string, text string")
    x = x.withColumn("words", split_words(F.col("text")))
    x = x.select("template", "license", F.array_distinct(shingle_texts(F.col("words"))).alias("shingles"), F.array_distinct(shingle_hashes(F.col("words"))).alias("hashes"))
    return x.withColumn("n", F.size("shingles")).withColumn("class", F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int"))


def _bands(signature: list[Column]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("band"), s.alias("value")) for i, s in enumerate(signature)])).alias("b")


def _least(i: int) -> Column:
    """A template's MinHash under function i."""
    return F.array_min(F.transform("hashes", lambda h: F.xxhash64(h, F.lit(i))))


def scan(docs: DataFrame, rows: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, license, template, containment): the best window of each template found in a text."""
    spark = docs.sparkSession
    known = Staged(templates(spark, rows), "templates").df
    dictionary = F.broadcast(known.select(F.explode("hashes").alias("h")).distinct())
    texts = keyed(docs)
    classes = sorted(r[0] for r in known.select("class").distinct().collect())
    near = hits(texts, dictionary)
    # shingle positions from j * w to (j + 2) * w - 1 are window j; the first window is -1
    windows = F.explode(F.array(*[F.struct(F.lit(w).alias("class"), (F.floor(F.col("at") / w) - back).cast("long").alias("window")) for w in classes for back in (0, 1)]))
    cut = near.select("doc_id", "text_hash", "h", windows.alias("w")).select("doc_id", "text_hash", "h", "w.*")
    least = [F.min(F.xxhash64("h", F.lit(i))).alias(f"m{i}") for i in range(BANDS)]
    signed = cut.groupBy("doc_id", "text_hash", "class", "window").agg(*least)
    of_windows = signed.select("doc_id", "text_hash", "class", "window", _bands([F.col(f"m{i}") for i in range(BANDS)])).select("doc_id", "text_hash", "class", "window", "b.*")
    of_templates = known.select("template", "class", _bands([_least(i) for i in range(BANDS)])).select("template", "class", "b.*")
    met = of_windows.join(F.broadcast(of_templates), ["class", "band", "value"]).select("doc_id", "text_hash", "window", "template").distinct()
    candidates = Staged(met.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("window", "template")).alias("found")), "license-candidates").df
    by_doc = sized(candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "found"), BROADCAST_DOCS)
    again = texts.join(by_doc, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")))
    word_rows = again.select("doc_id", "text_hash", "found", split_words(F.col("text")).alias("words"))
    pairs = word_rows.select("doc_id", "text_hash", F.explode_outer("found").alias("f"), "words").select("doc_id", "text_hash", "f.window", "f.template", "words")
    both = pairs.join(F.broadcast(known.select("template", "license", "shingles", "n", "class")), "template")
    first = F.greatest(F.col("window") * F.col("class"), F.lit(0)).cast("int")
    part = F.slice("words", first + 1, (F.col("window") + 2).cast("int") * F.col("class") - first + SHINGLE - 1)
    shares = both.select("doc_id", "text_hash", "license", "template", "shingles", "n", part.alias("part"))
    shares = shares.withColumn("containment", F.size(F.array_intersect("shingles", shingle_texts(F.col("part")))) / F.col("n"))
    return shares.filter(F.col("containment") >= threshold).groupBy("doc_id", "text_hash", "license", "template").agg(F.max("containment").alias("containment"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    return found.groupBy("doc_id", "license", "template").agg(F.max("containment").alias("containment"))


def _oracle() -> str:
    rows = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
    return f"""
WITH l(template, license, text) AS (VALUES {rows}),
k AS (SELECT template, license, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM l),
s AS (SELECT DISTINCT template, license, array_to_string(w[p:p + 4], ' ') AS g FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS p FROM k)),
n AS (SELECT template, count(*) AS n, CAST(2 ** ceil(log2(count(*))) AS BIGINT) AS c FROM s GROUP BY template),
d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, p - 1 AS spot, array_to_string(w[p:p + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p FROM d WHERE len(w) > 0)),
h AS (SELECT doc_id, spot, g, template, license, n, c FROM t JOIN s USING (g) JOIN n USING (template)),
v AS (SELECT *, spot // c - back AS win FROM h, (VALUES (0), (1)) b(back)),
x AS (SELECT doc_id, win, template, license, count(DISTINCT g) / max(n) AS containment FROM v GROUP BY doc_id, win, template, license)
SELECT doc_id, license, template, max(containment) AS containment FROM x WHERE containment >= 0.8 GROUP BY doc_id, license, template
"""


ORACLE_OP9 = _oracle()
