"""License scans by MinHash bands over overlapping windows (operator 1), in DataFrame functions only.

Templates are put into classes by their number of shingles, doubling from class to class. Each class cuts documents
into windows of twice its largest template, half overlapping, so that one window holds a template whole; the bands are
as many as retrieve it with probability ``TARGET``. Retrieved pairs are verified by exact containment of the template's
shingles of words in the window.

A window can share a band with a template only if it holds a shingle that is a smallest one of a template. Documents
and windows without any are left out before bands are computed.

Defined results: null and empty texts and texts of fewer than ``SHINGLE`` words match nothing; of several windows with
the same containment the first counts; rows of one id count as one document; an empty table gives an empty result;
extra columns are ignored, null ids are passed on.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
TARGET = 0.9999
#: MinHash functions that must agree in one band.
ROWS = 1
WORDS = "[^\\p{L}\\p{N}]+"

# Short notices of public licences.
TEMPLATES = {
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License."
    ),
    "MIT short": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software."
    ),
    "GPL-3.0 short": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0 short": "This work is licensed under the GNU General Public License, version 2",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0 short": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0 short": "Licensed under CC BY-SA 4.0",
    "All rights reserved": "All rights reserved. No part of this publication may be reproduced",
}


@dataclass(frozen=True)
class SizeClass:
    """Templates of ``least`` to twice ``least`` shingles, and the windows they are looked for in."""

    number: int
    least: int
    bands: int

    @property
    def window(self) -> int:
        return 4 * self.least

    @property
    def step(self) -> int:
        return 2 * self.least


def bands_needed(containment: float = CONTAINMENT, rows: int = ROWS, target: float = TARGET) -> int:
    """Bands of which one meets with probability ``target`` at the least similarity of template and window."""
    least = containment / (4 + 1 - containment)
    return math.ceil(math.log(1 - target) / math.log(1 - least**rows))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORDS), "")


def _sequence(count: Column) -> Column:
    """1 to ``count``, or nothing."""
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column) -> Column:
    """Hashes of the shingles, from one hash of each word."""

    def of_words(hashes: Column) -> Column:
        first = F.slice(hashes, 1, F.greatest(F.size(hashes) - (SHINGLE - 1), F.lit(0)))
        return F.transform(first, lambda h, i: F.xxhash64(h, *(hashes[i + step] for step in range(1, SHINGLE))))

    return bound(F.transform(words, lambda word: F.xxhash64(word)), of_words)


def shingle_texts(words: Column) -> Column:
    def of_words(known: Column) -> Column:
        places = _sequence(F.size(known) - (SHINGLE - 1))
        return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice(known, i, SHINGLE), " ")))

    return bound(words, of_words)


def band_values(hashes: Column, bands: int) -> Column:
    """The values of each band's functions over a set of shingles."""
    functions = F.sequence(F.lit(0), F.lit(bands * ROWS - 1))
    least = F.transform(functions, lambda f: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, f))))
    numbers = F.sequence(F.lit(0), F.lit(bands - 1))
    return bound(least, lambda known: F.transform(numbers, lambda b: F.xxhash64(F.slice(known, b * ROWS + 1, ROWS))))


def templates(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """The templates with their words, shingles and class; a constant table of a few kilobytes."""
    if not texts:
        texts = {"": ""}
    pairs = [F.struct(F.lit(name).alias("template"), F.lit(body).alias("body")) for name, body in texts.items()]
    rows = spark.range(1).select(F.inline(F.array(*pairs)))
    return (
        rows.select("template", bound(words_of(F.col("body")), lambda w: F.struct(
            shingle_hashes(w).alias("hashes"), shingle_texts(w).alias("shingles"))).alias("t"))
        .select("template", "t.*")
        .where(F.size("shingles") > 0)
        .withColumn("class", F.floor(F.log2(F.size("shingles"))).cast("int"))
    )


def licenses(docs: DataFrame, texts: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, template, containment and first word of the best window, for each template that a document holds."""
    spark = docs.sparkSession
    known = templates(spark, texts)
    classes = [
        SizeClass(row["class"], 1 << row["class"], bands_needed())
        for row in known.select("class").distinct().orderBy("class").collect()
    ]
    if not classes:
        nothing = {"template": F.lit(""), "containment": F.lit(0.0), "word": F.lit(0).cast("bigint")}
        return docs.select("doc_id", *(value.alias(name) for name, value in nothing.items())).limit(0)
    bands = classes[0].bands
    functions = F.sequence(F.lit(0), F.lit(bands * ROWS - 1))
    # The shingle that gives each function's smallest value, over all templates: a constant of the plan.
    seeds = sorted(
        {
            row[0]
            for row in known.select(
                F.explode(
                    F.transform(
                        functions,
                        lambda f: F.array_min(
                            F.transform("hashes", lambda h: F.struct(F.xxhash64(h, f).alias("v"), h.alias("h")))
                        )["h"],
                    )
                )
            ).collect()
        }
    )
    seed_list = F.expr(f"array({', '.join(f'{seed}L' for seed in seeds)})")

    def cut(words: Column, hashes: Column, found: Column, c: SizeClass) -> Column:
        around = F.transform(found, lambda i: F.floor((i - 1) / c.step).cast("int"))
        numbers = F.array_distinct(F.concat(around, F.transform(around, lambda n: F.greatest(n - 1, F.lit(0)))))
        return F.transform(
            numbers,
            lambda n: F.struct(
                F.lit(c.number).alias("class"),
                (n * c.step).alias("word"),
                F.slice(hashes, n * c.step + 1, c.window).alias("hashes"),
                F.array_join(F.slice(words, n * c.step + 1, c.window + SHINGLE - 1), " ").alias("said"),
            ),
        )

    def windows(words: Column, hashes: Column) -> Column:
        """The windows that hold a seed, with their words; nothing longer goes any further."""

        def around(seeds_here: Column) -> Column:
            places = F.filter(
                _sequence(F.size(hashes)), lambda i: F.array_contains(seeds_here, F.element_at(hashes, i))
            )
            return F.when(
                F.size(seeds_here) > 0, bound(places, lambda p: F.concat(*(cut(words, hashes, p, c) for c in classes)))
            )

        return bound(F.array_intersect(hashes, seed_list), around)

    # One expression of the text, so that no rewrite of the plan can put its parts into an inner loop. The outer
    # form of explode keeps Spark from computing it once more for a filter.
    held = bound(words_of(F.col("text")), lambda w: bound(shingle_hashes(w), lambda h: windows(w, h)))
    values = F.explode_outer(band_values(F.col("w.hashes"), bands)).alias("value")
    candidates = (
        docs.select("doc_id", F.explode_outer(held).alias("w"))
        .where("w IS NOT NULL")
        .select("doc_id", "w.class", "w.word", "w.said", values)
    )
    banded = known.select("template", "class", F.posexplode(band_values(F.col("hashes"), bands)).alias("band", "value"))
    # The bands' number is part of their values, as each has functions of its own.
    found = ["doc_id", "class", "word", "said", "template"]
    pairs = candidates.join(F.broadcast(banded.drop("band")), ["class", "value"]).select(found).dropDuplicates(found)
    own = shingle_texts(F.split("said", " "))
    share = F.size(F.array_intersect("shingles", "own")) / F.size("shingles")
    verified = (
        pairs.join(F.broadcast(known.select("template", "shingles")), "template")
        .select("doc_id", "template", "word", "shingles", own.alias("own"))
        .select("doc_id", "template", "word", share.alias("containment"))
        .where(F.col("containment") >= CONTAINMENT)
    )
    best = F.max(F.struct(F.col("containment"), (-F.col("word")).alias("back"))).alias("best")
    return verified.groupBy("doc_id", "template").agg(best).select(
        "doc_id", "template", "best.containment", (-F.col("best.back")).cast("bigint").alias("word")
    )


def license_sql(texts: dict[str, str] = TEMPLATES) -> str:
    """The same by comparing all windows with all templates, for DuckDB."""
    values = ", ".join(f"('{name}', '{body}')" for name, body in ((n, b.replace("'", "''")) for n, b in texts.items()))
    words = "regexp_extract_all(lower(coalesce({0}, '')), '[\\p{{L}}\\p{{N}}]+')"
    return f"""
WITH templates(template, body) AS (VALUES {values}),
t_words AS (SELECT template, {words.format("body")} AS w FROM templates),
t_shingles AS (
    SELECT DISTINCT template, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') AS shingle
    FROM t_words, unnest(range(1, len(w) - {SHINGLE - 2})) AS r(i)),
t_sizes AS (SELECT template, count(*) AS n, CAST(floor(log2(count(*))) AS INT) AS class FROM t_shingles GROUP BY template),
d_words AS (SELECT doc_id, {words.format("text")} AS w FROM documents),
d_shingles AS (
    SELECT doc_id, i - 1 AS place, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') AS shingle
    FROM d_words, unnest(range(1, len(w) - {SHINGLE - 2})) AS r(i)),
hits AS (
    SELECT doc_id, template, n, place, shingle, CAST(pow(2, class) AS BIGINT) * 2 AS step
    FROM d_shingles JOIN t_shingles USING (shingle) JOIN t_sizes USING (template)),
windows AS (
    SELECT doc_id, template, n, (place // step - b) * step AS word, shingle
    FROM hits, (VALUES (0), (1)) AS back(b) WHERE place // step >= b),
counted AS (
    SELECT doc_id, template, word, count(DISTINCT shingle) / n AS containment
    FROM windows GROUP BY doc_id, template, n, word)
SELECT doc_id, template, containment, word FROM counted WHERE containment >= {CONTAINMENT}
QUALIFY row_number() OVER (PARTITION BY doc_id, template ORDER BY containment DESC, word) = 1"""
