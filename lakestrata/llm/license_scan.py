"""License scans: normalised text compared to licence templates by Dice coefficient over word bigrams.
DataFrame functions only.

Units of a document are its lines, its paragraphs (between lines without a letter or digit, so a comment block's
empty lines part them too), its sentences and the whole text. A unit is lower-cased, everything but letters and
digits separates words (comment markers with it), and its distinct word bigrams are compared with each
template's: 2 * shared / (unit + template). At a threshold t a unit of a bigrams can only reach a template of b if
t / (2 - t) * b <= a <= (2 - t) / t * b, so templates outside those bounds are never compared. A match shares at
least t / (2 - t) of a template's bigrams; a few of its words therefore cannot all be missing, and texts and units
without any of these words are left out before their bigrams are made. Templates are a fixed list, part of the
plan as a literal. A licence that is named inside a longer sentence is not found.

Null text has no units. Documents without a match get a null license and dice 0. Rows that repeat an id
are rows of their own; an empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import let

THRESHOLD = 0.8

# Public licence statements, notices and paragraphs of licence texts (name, licence, text).
TEMPLATES: list[tuple[str, str, str]] = [
    ("mit-released", "MIT", "Released under the MIT License."),
    ("mit-licensed", "MIT", "Licensed under the MIT License."),
    ("mit-grant", "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions:"),
    ("mit-notice", "MIT", "The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software."),
    ("mit-warranty", "MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
     "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
     "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
     "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("apache-short", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-notice", "Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-warranty", "Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed "
     "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
     "express or implied. See the License for the specific language governing permissions and limitations under the "
     "License."),
    ("gpl3-short", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3-notice", "GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
     "of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("gpl-warranty", "GPL-3.0", "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
     "General Public License for more details."),
    ("mpl-notice", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
     "a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("bsd-grant", "BSD", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("isc-grant", "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
     "copies."),
    ("unlicense", "Unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc-short", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-short", "CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-notice", "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("reserved", "proprietary", "All rights reserved."),
    ("mit-project", "MIT", "This project is licensed under the MIT License."),
    ("apache-project", "Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("gpl2-notice", "GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms "
     "of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
     "or (at your option) any later version."),
    ("gpl2-short", "GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-copy", "GPL-3.0", "You should have received a copy of the GNU General Public License along with this program. "
     "If not, see https://www.gnu.org/licenses/."),
    ("lgpl-notice", "LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms "
     "of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
     "License, or (at your option) any later version."),
    ("agpl3-notice", "AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
     "of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("bsd-source", "BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions "
     "and the following disclaimer."),
    ("bsd-binary", "BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of "
     "conditions and the following disclaimer in the documentation and/or other materials provided with the "
     "distribution."),
    ("bsd3-name", "BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used "
     "to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-short", "BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE "
     "file."),
    ("cc-by-sa-short", "CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
]


def _joined(*names: str) -> str:
    wording = {name: text for name, _, text in TEMPLATES}
    return " ".join(wording[n] for n in names)


# Bodies whose parts stand together without a line between them.
TEMPLATES += [
    ("mit-body", "MIT", _joined("mit-grant", "mit-notice", "mit-warranty")),
    ("gpl3-header", "GPL-3.0", _joined("gpl3-notice", "gpl-warranty", "gpl-copy")),
    ("gpl2-header", "GPL-2.0", _joined("gpl2-notice", "gpl-warranty")),
    ("apache-header", "Apache-2.0", _joined("apache-notice", "apache-warranty")),
]
# Words that any text has: not asked for unless a template has no others.
COMMON = set("a an and any are as at be by can for from if in is it its may must not of on or see that the these this to "
             "under with without you".split())


def template_bigrams(text: str) -> list[str]:
    found = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(found, found[1:], strict=False)})


def size_bounds(size: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Least and greatest number of bigrams that can reach ``threshold`` with a template of ``size``."""
    t = Fraction(str(threshold))
    return math.ceil(t / (2 - t) * size), math.floor((2 - t) / t * size)


def telling_words(templates, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every unit that reaches ``threshold`` with a template has one.

    A match lacks at most b - t / (2 - t) * b of a template's b bigrams, so words that occur in more of its
    bigrams than that cannot all be missing.
    """
    found: set[str] = set()
    for _, _, wording in templates:
        grams = [set(g.split()) for g in template_bigrams(wording)]
        need = len(grams) - size_bounds(len(grams), threshold)[0] + 1
        hit = [bool(g & found) for g in grams]
        while sum(hit) < need:
            gain = {w: sum(w in g for g, h in zip(grams, hit, strict=True) if not h) for g in grams for w in g}
            word = min(gain, key=lambda w: (w in COMMON, -gain[w], w))
            found.add(word)
            hit = [h or word in g for g, h in zip(grams, hit, strict=True)]
    return sorted(found)


_BREAK = r"\n(?:[^\p{L}\p{N}\n]*\n)+"


def units(text: Column) -> Column:
    """Lines, paragraphs, sentences and the whole of a text, each once."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    sentences = F.regexp_replace(text, r"([.!?])[\x20\x09-\x0D]+", "$1\n\n")
    return F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, _BREAK), F.split(sentences, _BREAK), F.array(text)))


def unit_bigrams(unit: Column) -> Column:
    """Distinct word bigrams of a normalised unit, joined by a space."""
    tokens = F.array_remove(F.split(F.lower(unit), r"[^\p{L}\p{N}]+"), "")
    return let(tokens, lambda w: F.when(F.size(w) > 1, F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1)))))
        .otherwise(F.array().cast("array<string>")))


def matches(text: Column, threshold: float = THRESHOLD, templates=None) -> Column:
    """array<struct(miss, template, license)>, one for each unit and template that reach the threshold;
    ``miss`` is 1 - dice, so the least is the best."""
    table = []
    for name, license_id, wording in templates or TEMPLATES:
        grams = template_bigrams(wording)
        low, high = size_bounds(len(grams), threshold)
        table.append(F.struct(F.lit(name).alias("name"), F.lit(license_id).alias("license"), F.lit(low).alias("low"),
                              F.lit(high).alias("high"), F.array(*map(F.lit, grams)).alias("grams")))
    least = min(size_bounds(len(template_bigrams(t[2])), threshold)[0] for t in templates or TEMPLATES)

    def of_unit(b: Column) -> Column:
        near = F.filter(F.array(*table), lambda t: F.size(b).between(t["low"], t["high"]))
        scored = F.transform(near, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(b, t["grams"])) / (F.size(b) + F.size(t["grams"]))).alias("dice"),
            t["name"].alias("template"), t["license"].alias("license")))
        return F.filter(scored, lambda m: m["dice"] >= threshold)

    telling = r"(?<![\p{L}\p{N}])(?:" + "|".join(telling_words(templates or TEMPLATES, threshold)) + r")(?![\p{L}\p{N}])"

    def may_match(c: Column) -> Column:
        return F.lower(c).rlike(telling)

    # a unit of fewer characters than a word and a gap for each word of the least match can't match
    some = F.filter(units(text), lambda u: (F.length(u) >= 2 * least + 1) & may_match(u))
    found = F.flatten(F.transform(some, lambda u: let(unit_bigrams(u), of_unit)))
    none = F.array().cast("array<struct<dice: double, template: string, license: string>>")
    return F.when(F.coalesce(may_match(text.cast("string")), F.lit(False)), found).otherwise(none)


def license_scan(docs: DataFrame, threshold: float = THRESHOLD, templates=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, license and template of the best match, dice, n_matches and
    licenses (all that were found, sorted, comma-separated)."""
    found = docs.select("doc_id", matches(F.col("text"), threshold, templates).alias("m"))
    best = F.array_min(F.transform("m", lambda m: F.struct((-m["dice"]).alias("minus"), m["template"].alias("template"),
                                                           m["license"].alias("license"))))
    return found.select("doc_id", best.alias("best"), "m").select(
        "doc_id", F.col("best.license").alias("license"), F.col("best.template").alias("template"),
        F.coalesce(-F.col("best.minus"), F.lit(0.0)).alias("dice"), F.size("m").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda m: m["license"]))), ",").alias("licenses"))
