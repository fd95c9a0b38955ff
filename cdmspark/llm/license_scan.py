"""License notices in texts: MinHash bands over overlapping word-shingle windows retrieve
templates, then the containment of a template's shingles in the window is checked exactly.

Words are lower-cased and freed of ASCII punctuation; shingles have five words (a template
with fewer is one shingle). Templates of n shingles meet windows of 2m shingles, m the power of
two from n up, wherever they start, so inserted words cost a notice its containment only where
they spread it over more than 2m. A window with 0.8 of a template's shingles has a Jaccard
similarity of at least 0.19 with it: 64 bands of one MinHash each miss that with a probability
of at most 2e-6.

Any window holds no more template shingles than the one that starts at its first of them, and
only a window that holds enough of them can reach the containment. So only such windows are
hashed, and of those only ones not covered by the window before; this loses nothing. Main path:
row expressions over whole texts, with no shuffle; the templates are literals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmspark.llm.common import or_null, read_table

WIDTH, BANDS, CONTAINMENT = 5, 64, 0.8

# Notices as their licenses word them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED."),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+"), "")


def shingles(words: str, width: int) -> Column:
    """Hashes of the word shingles in their order; none with fewer words."""
    parts = ", ".join(f"`{words}`[int(i) + {j}]" for j in range(width))
    return F.expr(f"CASE WHEN size(`{words}`) < {width} THEN array() ELSE transform(sequence(0, size(`{words}`) - {width}), "
                  f"i -> xxhash64({parts})) END").cast("array<bigint>")


def bands(items: str) -> str:
    """SQL for the MinHash bands of an array of shingle hashes; the band number is in the value."""
    return (f"transform(sequence(0, {BANDS - 1}), j -> xxhash64(array_min(transform({items}, x -> xxhash64(x, j))), j))")


def _best(windows: Column, mine: Column, keys: Column) -> Column:
    """Most shingles of a template in a window that one of its bands retrieves."""
    near = F.filter(windows, lambda x: F.arrays_overlap(x["b"], keys))
    return F.array_max(F.transform(near, lambda x: F.size(F.array_intersect(x["s"], mine))))


class Scanner:
    """Templates by (shingle width, half a window's size), as literals."""

    def __init__(self, spark: SparkSession, templates: dict[str, str], containment: float):
        self.containment = containment
        own = spark.createDataFrame(sorted(templates.items()), "name string, text string")
        own = own.withColumn("words", plain_words(F.col("text"))).filter("size(words) > 0")
        own = own.withColumn("width", F.least(F.size("words"), F.lit(WIDTH)))
        by_width = F.lit(None).cast("array<bigint>")
        for w in range(1, WIDTH + 1):
            by_width = F.when(F.col("width") == w, shingles("words", w)).otherwise(by_width)
        own = own.withColumn("set", F.array_distinct(by_width)).withColumn("bands", F.expr(bands("`set`")))
        self.groups: dict[tuple[int, int], list] = {}
        for r in own.select("name", "width", "set", "bands").collect():  # one row per template
            half = 1 << (len(r["set"]) - 1).bit_length()
            self.groups.setdefault((r["width"], half), []).append(r)
        self.widths = sorted({w for w, _ in self.groups})

    def matches(self, words: str, prefix: str, df: DataFrame) -> DataFrame:
        """``df`` with array column ``<prefix>found`` of (name, containment), by name."""
        longs = lambda v: F.array(*[F.lit(x) for x in v])
        for w in self.widths:
            df = df.withColumn(f"{prefix}s{w}", shingles(words, w))
        found = []
        for g, ((w, half), rows) in enumerate(sorted(self.groups.items())):
            items, every = F.col(f"{prefix}s{w}"), sorted({x for r in rows for x in r["set"]})
            wins, col, n = f"{prefix}w{g}", f"{prefix}s{w}", 2 * half
            need = max(1, math.ceil(self.containment * min(len(r["set"]) for r in rows)))
            df = df.withColumn(prefix + "own", longs(every))
            # the places are bound once, as a; an own column would be copied into each use of it
            places = f"filter(sequence(0, size(`{col}`) - 1), i -> array_contains(`{prefix}own`, `{col}`[i]))"
            order = f"CASE WHEN size(a) >= {need} THEN sequence(0, size(a) - {need}) ELSE cast(array() AS array<int>) END"
            covered = f"a[greatest(k - 1, 0)] + {n}"  # places from here on are not in the window before
            starts = (f"filter({order}, k -> a[k + {need - 1}] - a[k] < {n} AND (k = 0 OR "
                      f"exists(slice(a, k + 1, {n + 1}), q -> q >= {covered} AND q < a[k] + {n})))")
            cut = f"transform(array({places}), a -> transform({starts}, k -> slice(`{col}`, a[k] + 1, {n})))[0]"
            df = df.withColumn(wins, F.when(F.arrays_overlap(items, F.col(prefix + "own")), F.expr(
                f"transform({cut}, s -> named_struct('s', s, 'b', {bands('s')}))"))).drop(prefix + "own")
            for r in rows:
                least = F.lit(self.containment * len(r["set"]))
                mine, keys = longs(r["set"]), longs(r["bands"])
                best = _best(F.col(wins), mine, keys)
                found.append(F.when(best >= least, F.struct(F.lit(r["name"]).alias("name"),
                                                            (best / len(r["set"])).alias("containment"))))
        wins = [f"{prefix}w{g}" for g in range(len(self.groups))]
        df = df.withColumn(prefix + "found", F.array_sort(F.array_compact(F.array(*found))))
        n = sum((F.coalesce(F.size(F.col(c)), F.lit(0)) for c in wins), F.lit(0))
        return (df.withColumn(prefix + "windows", F.when(F.col(prefix + "found").isNotNull(), n).cast("long"))
                .drop(*wins, *[f"{prefix}s{w}" for w in self.widths]))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_windows (hashed),
    n_licenses, licenses (names, sorted, joined by commas) and best (containment, 0 if none).

    Null and empty texts have no words and no licenses. Null ids and repeated rows are rows like
    any other; other columns are ignored; an empty table gives no rows."""
    base = docs.select(or_null(docs, "doc_id", "long").alias("doc_id"), or_null(docs, "text", "string").alias("text"))
    scanner = Scanner(docs.sparkSession, TEMPLATES if templates is None else templates, containment)
    out = scanner.matches("words", "_", base.withColumn("words", plain_words(F.col("text"))).drop("text"))
    return out.select("doc_id", F.size("words").cast("long").alias("n_words"), F.col("_windows").alias("n_windows"),
                      F.size("_found").cast("long").alias("n_licenses"),
                      F.array_join(F.transform("_found", lambda x: x["name"]), ",").alias("licenses"),
                      F.coalesce(F.array_max(F.transform("_found", lambda x: x["containment"])), F.lit(0.0)).alias("best"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))
