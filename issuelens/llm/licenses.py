"""License scans: MinHash bands over overlapping text windows, then exact shingle containment. Built-in expressions only.

Texts and templates become lower-case words of letters and digits and 5-word shingles. For each template
length there are windows of that many shingles, each overlapping the next by three quarters (by all but one
shingle for the shortest). A window and a template meet when one of BANDS seeded minima over their shingles
agrees: with Jaccard similarity j the chance is 1 - (1 - j) ** BANDS, above 0.9999 for j >= 0.5, which a
template that is 0.75 contained in the text reaches in its best window. The shingle that gives an agreeing
minimum lies in both sets, so only windows with a shingle of some template are hashed; no other can meet one.
A retrieved template is confirmed by the exact share of its shingles within the window and its overlap.

Edge cases: a null or empty text has no shingles and no row. A text of fewer than five words has none either.
A template shorter than five words is refused. Rows that share a doc_id (or have none) are reported together;
templates of equal containment are all reported. Repeated rows change nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.llm.common import stored

WORDS = 5
BANDS = 16
CONTAINED = 0.75

# Notices as their publishers word them; fixed values.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
}


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(words: str) -> Column:
    """The 5-word shingles of an array column of words, as structs in order."""
    n = F.greatest(F.size(words) - WORDS + 1, F.lit(0))
    return F.arrays_zip(*(F.slice(words, k + 1, n).alias(f"w{k}") for k in range(WORDS)))


def spelled(words: str) -> Column:
    """The shingles as strings, for exact comparison."""
    return F.transform(shingles(words), lambda s: F.concat_ws(" ", *(s[f"w{k}"] for k in range(WORDS))))


def minima(keys: Column) -> Column:
    """Seeded minima over an array of shingle hashes, one per band."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(keys, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*map(least, range(BANDS)))


def template_table(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """(license, template, n, template_keys, template_shingles): a few rows, whose number the caller's templates bound."""
    rows = [(name, k, text) for name, texts in templates.items() for k, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "license string, template int, text string").withColumn("words", tokens(F.col("text")))
    keys = F.array_distinct(F.transform(shingles("words"), lambda s: F.xxhash64(s)))
    table = table.withColumn("template_keys", keys).withColumn("template_shingles", F.array_distinct(spelled("words")))
    return table.withColumn("n", F.size("template_shingles")).drop("text", "words")


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, license, containment, first_word, n_windows): licenses found, with the best window and how many confirm it."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    short = [t for texts in templates.values() for t in texts if len(re.findall(r"\w+", t)) < WORDS]
    if short:
        raise ValueError(f"templates need {WORDS} words: {short}")
    known = template_table(spark, templates)
    facts = known.collect()
    lengths = sorted({row.n for row in facts})
    everything = F.array(*(F.lit(key) for key in sorted({key for row in facts for key in row.template_keys})))

    texts = docs.select("doc_id", tokens(F.coalesce("text", F.lit(""))).alias("words"))
    texts = texts.withColumn("keys", F.transform(shingles("words"), lambda s: F.xxhash64(s)))
    # Few texts go on: those with a shingle of some template.
    texts = stored(texts.where(F.arrays_overlap("keys", everything)).select("doc_id", "words", "keys"), "license-texts")
    places = F.filter(
        F.transform("keys", lambda h, i: F.when(F.array_contains(everything, h), i)), lambda i: i.isNotNull()
    )
    size = F.explode(F.array(*(F.lit(n) for n in lengths))).alias("n")
    windows = texts.withColumn("places", places).select("doc_id", "words", "keys", "places", size)
    step = F.greatest(F.floor(F.col("n") / 4), F.lit(1)).cast("int")
    # Windows start at multiples of the step; those that hold a place start at it or less than n before it.
    windows = windows.withColumn("step", step)
    ahead = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / F.col("step")).cast("int"))
    starts = F.array_distinct(
        F.flatten(F.transform("places", lambda p: F.transform(F.col("ahead"), lambda k: (F.floor(p / F.col("step")) - k).cast("int"))))
    )
    windows = windows.withColumn("ahead", ahead).withColumn("starts", F.filter(starts, lambda s: s >= 0))
    windows = windows.select("doc_id", "words", "keys", "n", "step", F.explode("starts").alias("k"))
    windows = windows.withColumn("start", F.col("k") * F.col("step"))
    windows = windows.withColumn("window", F.slice("keys", F.col("start") + 1, F.col("n"))).where(F.size("window") > 0)
    windows = windows.withColumn("bands", minima(F.col("window")))
    known = known.withColumn("template_bands", minima(F.col("template_keys")))
    met = windows.join(F.broadcast(known), "n").where(
        F.exists(F.zip_with("bands", "template_bands", lambda a, b: a == b), lambda same: same)
    )
    # The best window may lie up to a step to either side of the text's copy: the overlap is searched too.
    wide_from = F.greatest(F.col("start") - F.col("step"), F.lit(0))
    met = met.withColumn("near", F.slice("words", wide_from + 1, F.col("n") + 2 * F.col("step") + WORDS - 1))
    shared = F.size(F.array_intersect("template_shingles", spelled("near")))
    met = met.withColumn("containment", F.round(shared / F.col("n"), 6)).where(F.col("containment") >= contained)
    best = F.max_by(F.struct("containment", "start"), F.struct("containment", -F.col("start")))
    found = met.groupBy("doc_id", "license").agg(best.alias("best"), F.count_distinct("n", "start").alias("n_windows"))
    return found.select(
        "doc_id", "license", F.col("best.containment").alias("containment"), F.col("best.start").cast("long").alias("first_word"), "n_windows"
    )
