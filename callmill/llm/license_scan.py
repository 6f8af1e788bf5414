"""License statements in texts: MinHash bands over overlapping word windows retrieve templates, exact shingle containment
verifies them. Built-in functions only.

Templates are grouped by size. For templates of `t` shingles the windows hold `2 t` shingles and start every `t`, so
any `t` neighbouring shingles lie inside one window whole. A window that contains 0.8 of a template has a Jaccard
similarity of at least 0.8 t / (2 t + 0.2 t) = 4/11 with it. One row per band and 40 bands miss such a window with
a probability of (7/11) ** 40 < 2e-8.

Shingles that no template has are left out before windows are formed: no template's minimum can be theirs. That leaves
nothing of most texts, so only what is left is written as rows: a row for each window and band, joined with the table of the
templates' minima. Only the windows that meet a template in a band are compared with it. The work of a text does not grow
with the number of templates, only the two sets that its words and shingles are looked up in do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.llm.common import matched, prepare, saved, text_of

# Statements to look for, shortest form first.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("mit", "Released under the MIT License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    (
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    (
        "mit-notice-conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    (
        "mit-notice-warranty",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",
    ),
    (
        "bsd-notice-source",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
    ),
    (
        "bsd-notice-binary",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "bsd-notice-warranty",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED.",
    ),
    (
        "isc-notice",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "apache-2.0-notice",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License.",
    ),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "lgpl-notice",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "agpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "cc0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
        "work.",
    ),
    (
        "cc-by-sa-4.0-notice",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "cc-by-4.0-notice",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
]
SHINGLE = 5
BANDS = 40
MIN_PERCENT = 80
WORD = r"[^\p{L}\p{N}]+"

KEY = ("doc_id", "_text_hash")
WINDOW = ("words", "size", "part")


def _words(column: Column) -> Column:
    return F.filter(F.split(F.lower(column), WORD), lambda w: w != "")


def _shingle(words: Column, at: Column, length: Column | int) -> Column:
    """Hash of the shingle from place `at`, counted from 0."""
    n = F.lit(length) if isinstance(length, int) else length
    return F.xxhash64(F.array_join(F.slice(words, at + 1, n), " "))


def _minima(shingles: Column) -> Column:
    """The least hash of the shingles in each band."""
    bands = F.sequence(F.lit(0), F.lit(BANDS - 1))
    return F.transform(bands, lambda b: F.array_min(F.transform(shingles, lambda s: F.xxhash64(b, s))))


def template_sets(spark: SparkSession, templates=None) -> DataFrame:
    """(license, words, size, firsts, shingles) of each template: the words of a shingle, fewer than SHINGLE where the template has
    fewer; the number of different shingles; their first words; their hashes. A template without words is left out."""
    rows = spark.createDataFrame(TEMPLATES if templates is None else templates, "license string, template string")
    split = rows.select("license", _words(F.col("template")).alias("w")).filter("size(w) > 0")
    split = split.withColumn("words", F.least(F.lit(SHINGLE), F.size("w")))
    places = F.sequence(F.lit(0), F.size("w") - F.col("words"))
    return split.select(
        "license",
        "words",
        F.array_distinct(F.transform(places, lambda i: F.get("w", i))).alias("firsts"),
        F.array_distinct(F.transform(places, lambda i: _shingle(F.col("w"), i, F.col("words")))).alias("shingles"),
    ).select("license", "words", F.size("shingles").alias("size"), "firsts", "shingles")


def _places(words: int, firsts: list[str], shingles: list[int]) -> Column:
    """The places of shingles that templates have. The word before the rest: most texts have few that begin one."""
    starts = F.filter(F.transform("_w", lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())
    found = F.transform(
        starts, lambda i: F.struct(F.lit(words).alias("words"), i.alias("i"), _shingle(F.col("_w"), i, words).alias("shingle"))
    )
    return F.filter(found, lambda p: p["shingle"].isin(shingles))


def windows(docs: DataFrame, sets: list) -> DataFrame:
    """(KEY, WINDOW, inside): every window of every text that has shingles of templates, and which."""
    by_words: dict[int, tuple[set, set, set]] = {}
    for t in sets:
        firsts, shingles, sizes = by_words.setdefault(t.words, (set(), set(), set()))
        firsts.update(t.firsts)
        shingles.update(t.shingles)
        sizes.add(t.size)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("_text_hash"), _words(text_of()).alias("_w")
    )
    if not by_words:
        return rows.select(*KEY, *[F.lit(0).alias(c) for c in WINDOW], F.array().cast("array<bigint>").alias("inside")).limit(0)
    places = F.concat(*[_places(n, sorted(f), sorted(s)) for n, (f, s, _) in sorted(by_words.items())])
    found = rows.select(*KEY, F.inline(places))
    sizes = [(n, size) for n, (_, _, every) in sorted(by_words.items()) for size in sorted(every)]
    # A row for each size that templates have.
    sized = docs.sparkSession.createDataFrame(sizes, "words int, size int")
    part = (F.col("i") / F.col("size")).cast("int")
    parts = F.explode(F.array(part, part - 1)).alias("part")
    return (
        found.join(F.broadcast(sized), "words")
        .select(*KEY, "words", "size", parts, "shingle")
        .groupBy(*KEY, *WINDOW)
        .agg(F.collect_set("shingle").alias("inside"))
    )


def retrieved(found: DataFrame, sets: DataFrame) -> DataFrame:
    """(KEY, WINDOW, inside, license): the windows that share a band's minimum with a template of their size."""
    own = found.select("*", F.posexplode(_minima(F.col("inside"))).alias("band", "least"))
    theirs = sets.select("license", "words", "size", F.posexplode(_minima(F.col("shingles"))).alias("band", "least"))
    # BANDS rows a template, a list that the caller gives; Spark would rather send the windows, which are small in a file.
    met = own.join(F.broadcast(theirs), ["words", "size", "band", "least"])
    return met.dropDuplicates([*KEY, *WINDOW, "license"]).select(*KEY, *WINDOW, "inside", "license")


def verified(met: DataFrame, sets: DataFrame) -> DataFrame:
    """(KEY, license) of the windows that contain enough of their template."""
    both = met.join(F.broadcast(sets.select("license", "shingles")), "license")
    enough = 100 * F.size(F.array_intersect("inside", "shingles")) >= MIN_PERCENT * F.col("size")
    return both.filter(enough).select(*KEY, "license").distinct()


def scan(docs: DataFrame, templates=None) -> DataFrame:
    """One row per document: doc_id, licenses (sorted names, comma-joined), n_licenses.

    A license is found if some window contains at least 80 % of its template's different shingles; words are runs of letters
    and digits, case ignored. Null and empty texts have none. Texts are looked at whole, whatever their length. Repeated rows each
    keep their row: rows with equal id and text get equal answers. An empty table gives no rows; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    sets = template_sets(spark, templates)
    given = sets.collect()  # the templates, a list that the caller gives
    sets = spark.createDataFrame(given, sets.schema)
    found = verified(retrieved(saved(windows(docs, given), "license-windows"), sets), sets)
    named = found.groupBy(*KEY).agg(F.array_sort(F.collect_set("license")).alias("_names"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("_text_hash"))
    return matched(rows, saved(named, "licenses"), KEY, "left").select(
        "doc_id",
        F.coalesce(F.array_join("_names", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.size("_names"), F.lit(0)).cast("long").alias("n_licenses"),
    )
