"""License scan: texts compared to licence templates by Dice over word bigrams.

Units of a text are the whole text, its paragraphs and its lines, each once. A
unit is lower-cased, everything but letters and digits becomes a blank, and its
word bigrams, repeats included, are compared to each template's: Dice is twice
the number of shared bigrams over the sum of both numbers. At least ``threshold``
(t) needs sizes whose ratio is within t/(2-t) and (2-t)/t, so a unit of n bigrams
is compared only to the templates in that range, and nearly all units of prose to
none. Everything happens in the row that holds the text: nothing is shuffled, and
the templates are a constant of the query.

Defined results: null or empty text, or one without two words, matches nothing
(null license, score 0); of equal scores the larger template wins, then the
greater id; repeated rows are scanned one by one; extra columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import ROW, let, text_of, unpack

THRESHOLD = 0.8

# Notices by licence id, as their licences ask for them or as they
# are commonly written, and short licence texts.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                   "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
                   "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Use of this source code is governed by the BSD 2-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _numbered(text: str) -> list[str]:
    """The bigrams of a template, each with how many equal ones come before."""
    words, seen, out = template_words(text), Counter(), []
    for pair in zip(words, words[1:]):
        gram = " ".join(pair)
        out.append(f"{gram} {seen[gram]}")
        seen[gram] += 1
    return out


def size_range(n: int, threshold: float) -> tuple[int, int]:
    """The sizes that can reach the threshold with a template of ``n`` bigrams."""
    t = round(threshold * 1000)
    return -(-n * t // (2000 - t)), n * (2000 - t) // t


def _words(unit: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "), " "), "")


def _bigrams(words: Column) -> Column:
    grams = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(words) - 1),
                                     lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))))
    return let(grams, lambda g: F.transform(g, lambda x, i: F.concat(x, F.lit(" "), (i + 1 - F.array_position(g, x)).cast("string"))))


def matches(text: Column, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """An array of (score, size, license), one for each unit and template at or over the threshold."""
    known = [(name, _numbered(t)) for name, t in templates]
    ranges = [size_range(len(g), threshold) for _, g in known]
    low, high = min(a for a, _ in ranges), max(b for _, b in ranges)
    table = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(len(g)).alias("size"), F.lit(a).alias("low"), F.lit(b).alias("high"),
                               F.array(*[F.lit(x) for x in g]).alias("grams")) for (name, g), (a, b) in zip(known, ranges)])
    fits = lambda w: (F.size(w) - 1 >= low) & (F.size(w) - 1 <= high)
    lines = F.transform(F.split(text, "\n"), _words)
    # A line end is a blank: the words of the whole are those of its lines.
    whole = lambda ls: F.when(F.aggregate(ls, F.lit(0), lambda a, w: a + F.size(w)) <= high + 1, F.flatten(ls)).otherwise(F.array().cast("array<string>"))
    gap = r"\n[\x20\t\r]*\n"
    paragraphs = F.when(text.rlike(gap), F.transform(F.split(text, gap), _words)).otherwise(F.array().cast("array<array<string>>"))
    units = let(lines, lambda ls: F.concat(F.filter(ls, fits), F.filter(F.array(whole(ls)), fits)))
    units = F.array_distinct(F.concat(units, F.filter(paragraphs, fits)))

    def compare(grams: Column) -> Column:
        near = F.filter(table, lambda t: (F.size(grams) >= t["low"]) & (F.size(grams) <= t["high"]))
        return F.transform(near, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(grams, t["grams"])) / (F.size(grams) + t["size"])).alias("score"),
            t["size"].alias("size"), t["license"].alias("license")))

    found = F.flatten(F.transform(units, lambda w: let(_bigrams(w), compare)))
    return F.filter(found, lambda m: m["score"] >= threshold)


def scan(docs: DataFrame, text: str = "text", carry: list[str] | None = None, templates: list[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """All rows (the columns in ``carry``, or all) with ``license`` (the best
    match), ``score``, ``licenses`` (all matched, sorted, distinct) and
    ``n_matches`` (unit and template pairs)."""
    carry = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW), matches(text_of(text), templates, threshold).alias("found"))
    best = F.array_max("found")
    judged = rows.select(ROW, best["license"].alias("license"), F.coalesce(best["score"], F.lit(0.0)).alias("score"),
                         F.sort_array(F.array_distinct(F.transform("found", lambda m: m["license"]))).alias("licenses"),
                         F.size("found").cast("long").alias("n_matches"))
    return unpack(judged, ["license", "score", "licenses", "n_matches"])
