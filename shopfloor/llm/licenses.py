"""Licence notices and texts in documents, by Dice coefficient over word bigrams.

A document is scanned by lines, by sentences, by paragraphs (between blank lines), by runs of paragraphs and
as a whole. A unit of n bigrams can only be as like a template of m bigrams as 2 min(n, m) / (n + m), so a
unit is compared with the templates whose size allows the threshold, and left alone if there is none. A run
begins with a paragraph that shares a bigram with a template, and goes on for as many paragraphs as the
sizes allow; so a licence of several paragraphs is found before or within other text. Of n bigrams of a
unit like a template, the template has n t / (2 - t) at least for the threshold t: units and runs with
fewer bigrams of any template are left out before they are compared. All of it is one projection: nothing
is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Licence ids, and the notices or texts that announce them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.'),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("reserved", "All rights reserved."),
]


#: Words that stand in texts of all kinds.
COMMON = {"a", "all", "and", "as", "at", "by", "for", "in", "is", "of", "on", "or", "the", "this", "to", "under", "with", "you"}


def bigrams_of(text: str) -> Counter:
    """Bigrams of a template, in its normal form."""
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Numbers of bigrams that a unit may have to be like a template of ``size`` bigrams."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def telling_words(grams: Counter, threshold: float) -> set[str]:
    """Words of which a unit as like the template as ``threshold`` must have one.

    Such a unit lacks so few of the template's bigrams that it can't lack all bigrams of these words. Long
    words come first, as they are rare elsewhere, and common ones last.
    """
    m = sum(grams.values())
    least_common = math.ceil(threshold * (bounds(m, threshold)[0] + m) / 2 - 1e-9)
    chosen: set[str] = set()
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (w in COMMON, -len(w), w)):
        if sum(c for g, c in grams.items() if chosen & set(g.split())) > m - least_common:
            break
        chosen.add(word)
    return chosen


def telling_bigrams(grams: Counter, threshold: float) -> set[str]:
    """Bigrams of which a unit as like the template as ``threshold`` must have one, chosen as ``telling_words`` are."""
    m = sum(grams.values())
    least_common = math.ceil(threshold * (bounds(m, threshold)[0] + m) / 2 - 1e-9)
    chosen: set[str] = set()
    for gram in sorted(grams, key=lambda g: (sum(w in COMMON for w in g.split()), -len(g), g)):
        if sum(grams[g] for g in chosen) > m - least_common:
            break
        chosen.add(gram)
    return chosen


def normal(text: Column) -> Column:
    """Lower-case words of letters and digits between single spaces; line ends stay."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")


def _flat(unit: Column) -> Column:
    return F.trim(F.regexp_replace(unit, r"[\n ]+", " "))


def paragraphs(plain: Column) -> Column:
    """Paragraphs of a text in normal form that have words, without line ends and outer spaces."""
    parts = F.split(F.regexp_replace(plain, r"\n ?(\n ?)+", "\u0001"), "\u0001")
    return F.filter(F.transform(parts, _flat), lambda p: p != "")


def units(text: Column, plain: Column, parts: Column) -> Column:
    """Lines, sentences, paragraphs (``parts``) and the whole of a text in normal form, without line ends and outer spaces."""
    lines = F.transform(F.split(plain, "\n"), lambda u: F.trim(u))
    sentences = F.transform(F.split(F.coalesce(text, F.lit("")), r"[.!?](?=[ \t\n\f\r])"), lambda s: _flat(normal(s)))
    return F.array_distinct(F.concat(lines, sentences, parts, F.array(_flat(plain))))


def sums(paired: Column, lists: Column, every: list[str]) -> Column:
    """Before each paragraph, and after the last: its number ``at`` from 0, the ``words`` and the bigrams of ``every`` (``known``) up to there.

    ``lists`` has the words of each paragraph, ``paired`` its bigrams. The bigram that joins a paragraph to the next counts with the former.
    """

    def of(b: Column, i: Column) -> Column:
        joint = F.concat(F.element_at(F.get(lists, i), -1), F.lit(" "), F.get(F.get(lists, i + 1), F.lit(0)))
        known = _known(b, every) + F.when(joint.isin(every), 1).otherwise(0)
        return F.struct(F.size(F.get(lists, i)).alias("words"), known.alias("known"))

    def added(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        return F.concat(done, F.array(F.struct((last["at"] + 1).alias("at"), (last["words"] + x["words"]).alias("words"), (last["known"] + x["known"]).alias("known"))))

    first = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("words"), F.lit(0).alias("known")))
    return F.aggregate(F.transform(paired, of), first, added)


def runs(parts: Column, before: Column, starts: Column, low: int, high: int, share: float) -> Column:
    """Runs of two paragraphs or more of ``low`` to ``high`` bigrams that begin at ``starts``, numbers from 0.

    ``before`` has the sums before each paragraph. Runs with less than ``share`` known bigrams are left out.
    """

    def of(start: Column) -> Column:
        def may(end: Column) -> Column:
            n = end["words"] - F.get(before, start)["words"] - 1
            return n.between(low, high) & (end["known"] - F.get(before, start)["known"] >= share * n - 1e-9)

        # Each paragraph has a word, so a run of more than high + 1 paragraphs is too long.
        ends = F.filter(F.slice(before, start + 3, F.lit(high)), may)
        return F.transform(ends, lambda e: F.array_join(F.slice(parts, start + 1, e["at"] - start), " "))

    return F.flatten(F.transform(starts, of))


def _split(texts: Column) -> Column:
    return F.transform(texts, lambda u: F.split(u, " "))


def _bigrams(lists: Column) -> Column:
    """Bigrams of each of some lists of words, as often as they occur.

    A list is a variable of its own here: an expression in its place would be worked out for each word anew.
    """
    return F.transform(lists, lambda w: F.transform(F.slice(w, F.lit(1), F.size(w) - 1), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1))))


def _known(grams: Column, every: list[str]) -> Column:
    return F.size(F.filter(grams, lambda g: g.isin(every)))


def _bigram_count(unit: Column) -> Column:
    return F.length(unit) - F.length(F.replace(unit, F.lit(" "), F.lit("")))


def scan(docs: DataFrame, text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``licenses``: structs (``license``, ``dice``), one for each licence found, with its best coefficient, by licence; a column of that name is replaced.

    Bigrams count as often as they occur. Licences of equal coefficients are all listed. Null and empty texts have no licence. Equal units of a document
    count once. Templates of fewer than two words are refused.
    """
    known = [(name, bigrams_of(body)) for name, body in templates]
    if any(not grams for _, grams in known):
        raise ValueError("a template needs two words at least")
    sizes = [bounds(sum(grams.values()), threshold) for _, grams in known]
    fits_any = lambda n: _any([n.between(low, high) for low, high in _joined(sizes)])
    every = sorted({g for _, grams in known for g in grams})
    # A template has so many of the bigrams of a unit that is like it, in parts of all.
    share = threshold / (2 - threshold)
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("license"),
                F.lit(sum(grams.values())).alias("n"),
                F.lit(low).alias("low"),
                F.lit(high).alias("high"),
                F.array(*[F.lit(g) for g in sorted(grams)]).alias("grams"),
                F.array(*[F.struct(F.lit(g).alias("gram"), F.lit(c).alias("c")) for g, c in sorted(grams.items()) if c > 1]).cast("array<struct<gram:string,c:int>>").alias("repeated"),
            )
            for (name, grams), (low, high) in zip(known, sizes)
        ]
    )
    # Each step is a column of its own: what is used more than once is then worked out once.
    steps = docs.select("*", normal(F.col(f"`{text}`")).alias("_licenses_plain"))
    telling = F.array(*[F.lit(w) for w in sorted(set().union(*[telling_words(grams, threshold) for _, grams in known]))])
    telling_grams = sorted(set().union(*[telling_bigrams(grams, threshold) for _, grams in known]))
    # The bigrams of all units are among those of the whole; words come first, as bigrams of every text would cost more.
    flat = F.split(F.trim(F.regexp_replace("_licenses_plain", r"[\n ]+", " ")), " ")
    worded = F.arrays_overlap(F.split(F.replace("_licenses_plain", F.lit("\n"), F.lit(" ")), " "), telling)
    told = F.exists(F.flatten(_bigrams(F.array(flat))), lambda g: g.isin(telling_grams))
    none = F.array().cast("array<string>")
    steps = steps.withColumn("_licenses_hopeful", F.when(worded, told).otherwise(False))
    steps = steps.withColumn("_licenses_parts", F.when(F.col("_licenses_hopeful"), paragraphs(F.col("_licenses_plain"))).otherwise(none))
    steps = steps.withColumn("_licenses_lists", _split(F.col("_licenses_parts")))
    steps = steps.withColumn("_licenses_paired", _bigrams(F.col("_licenses_lists")))
    steps = steps.withColumn("_licenses_sums", sums(F.col("_licenses_paired"), F.col("_licenses_lists"), every))
    # A run begins with a paragraph that shares a bigram with a template.
    shares = F.transform("_licenses_paired", lambda b: F.exists(b, lambda g: g.isin(every)))
    steps = steps.withColumn("_licenses_starts", F.filter(F.transform(shares, lambda s, i: F.when(s, i)), lambda i: i.isNotNull()))
    longer = runs(
        F.col("_licenses_parts"), F.col("_licenses_sums"), F.col("_licenses_starts"), min(low for low, _ in sizes), max(high for _, high in sizes), share
    )
    single = units(F.col(f"`{text}`"), F.col("_licenses_plain"), F.col("_licenses_parts"))
    steps = steps.withColumn("_licenses_units", F.when(F.col("_licenses_hopeful"), F.array_distinct(F.concat(single, longer))).otherwise(none))
    chosen = F.filter("_licenses_units", lambda u: fits_any(_bigram_count(u)))
    # A unit that is like a template has a telling word as well.
    paired = _bigrams(F.filter(_split(chosen), lambda w: F.arrays_overlap(w, telling)))
    steps = steps.withColumn("_licenses_likely", F.filter(paired, lambda b: _known(b, every) >= share * F.size(b) - 1e-9))

    def common(b: Column, t: Column) -> Column:
        """Bigrams of both: each once, and those the template repeats as often as both have them."""
        again = F.aggregate(t["repeated"], F.lit(0), lambda total, g: total + F.greatest(F.lit(0), F.least(g["c"], F.size(F.filter(b, lambda x: x == g["gram"]))) - 1))
        return F.size(F.array_intersect(b, t["grams"])) + again

    def judged(b: Column) -> Column:
        near = F.filter(table, lambda t: F.size(b).between(t["low"], t["high"]))
        return F.transform(near, lambda t: F.struct(t["license"].alias("license"), (2.0 * common(b, t) / (F.size(b) + t["n"])).alias("dice")))

    found = F.filter(F.flatten(F.transform("_licenses_likely", judged)), lambda f: f["dice"] >= threshold)
    steps = steps.withColumn("_licenses_found", found)
    names = F.array_sort(F.array_distinct(F.transform("_licenses_found", lambda f: f["license"])))

    def best(name: Column) -> Column:
        return F.array_max(F.transform(F.filter("_licenses_found", lambda f: f["license"] == name), lambda f: f["dice"]))

    listed = F.transform(names, lambda n: F.struct(n.alias("license"), best(n).alias("dice")))
    return steps.select(*[f"`{c}`" for c in docs.columns if c != "licenses"], listed.alias("licenses"))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same numbers in as few ranges as possible."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [tuple(r) for r in out]
