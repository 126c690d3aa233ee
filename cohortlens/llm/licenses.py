"""License scan (DataFrame functions only).

Texts and license templates are reduced to lower-case words without punctuation and to hashes of shingles of five
words (a template of fewer words is one shingle). Overlapping windows over a text's shingles get MinHash values, one
per band; the windows of templates, at every offset, are filed under theirs. A text is compared with the templates
that one of its windows meets in any band, by exact containment: the share of the template's shingles that the text has.

Bands hold one value each, so windows of Jaccard similarity s meet with probability 1 - (1 - s)^bands: 0.998 at 0.8 with
four bands, 1 for equal windows. Text windows are ``wide`` shingles long and begin every ``wide / 2``; any passage of
``1.5 wide`` shingles that agrees with the template holds a whole one, and meets for certain. Templates too short for
that are filed by single shingles, where any shared shingle meets for certain.

A text's windows are first held against one bit filter of all the templates' keys, a literal of 64 bits a key or so, four bits
a key, which lets about one other value in 100,000 through; what passes meets the keys in an equi-join, joined by broadcast as the templates fix their number and the data do not.

Telling phrases keep versions and relatives apart: of each, one shingle that holds it must be among the shared ones.

Defined cases: null, empty and blank texts match nothing; repeated rows are matched each; a template is reported once
per row; texts of any length are scanned whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPLIT, settle

WIDTH, WIDE, BANDS, LEAST = 5, 8, 4, 0.8
TURNS = (0, 15, 30, 45)  # places in a hash from which the bits of the filter are taken
#: What the bands add (by exclusive or) to the shingle hashes, which gives each band an order of its own.
ORDERS = (0, 0x5851F42D4C957F2D, -0x61C8864680B583EB, 0x2545F4914F6CDD1D, -0x4B47D0C5A8E3B1F7, 0x6A09E667F3BCC909, -0x4498517A7B3558C5, 0x3C6EF372FE94F82B)

# Notices, headers and permission texts as the licenses state them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "mit-permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software.""",
    "mit-warranty": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.""",
    "bsd-3-clause": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.""",
    "bsd-warranty": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising
from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "cc0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public
domain worldwide. This software is distributed without any warranty.""",
}
# The headers of one family differ in the name of the work, of the license, and the version.
HEADER = """This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the {license} as published by the Free Software
Foundation{comma} either version {version} of the License, or (at your option) any later version. This {work} is distributed in the hope that it will be useful, but
WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {license} for more details."""
FAMILY = {
    "gpl-3.0-header": ("program", "GNU General Public License", "3"), "gpl-2.0-header": ("program", "GNU General Public License", "2"),
    "lgpl-3.0-header": ("program", "GNU Lesser General Public License", "3"), "lgpl-2.1-header": ("library", "GNU Lesser General Public License", "2.1"),
    "agpl-3.0-header": ("program", "GNU Affero General Public License", "3"),
}
TEMPLATES |= {name: HEADER.format(work=work, license=text, version=v, mark=":" if v == "3" else ";", comma="," if v == "3" else ";") for name, (work, text, v) in FAMILY.items()}
TELLING = {"apache-2.0": ["version 2.0"], "apache-2.0-header": ["version 2.0"], "gpl-3.0": ["gnu general public", "version 3"], "gpl-2.0": ["gnu general public", "version 2"],
           "cc-by-4.0": ["attribution 4.0"], "cc-by-sa-4.0": ["attribution-sharealike 4.0"], "cc-by-nc-4.0": ["by-nc 4.0"], "mpl-2.0-header": ["mozilla public license"]}
TELLING |= {name: [" ".join(text.lower().split()[:3]), f"version {v}"] for name, (_, text, v) in FAMILY.items()}


def plain_words(text: Column) -> Column:
    """Lower-case words without ASCII punctuation at their ends; what is nothing but punctuation is no word."""
    bare = F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT, -1), lambda w: F.btrim(w, F.lit("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")))
    return F.filter(bare, lambda w: w != "")


def shingle_hashes(words: str, width: int) -> Column:
    """The hash of every ``width``-word shingle of the array column ``words`` of word hashes; all of it if it is shorter."""
    at = F.col(words)
    whole = F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(1))),
                        lambda h, i: F.xxhash64(h, *[F.get(at, i + k) for k in range(1, width)]))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(whole)


def hashed(df: DataFrame, text: Column, width: int) -> DataFrame:
    """``df`` with ``_shingles``."""
    df = df.withColumn("_plain", plain_words(text))
    df = df.withColumn("_words", F.transform("_plain", lambda w: F.xxhash64(w)))
    return df.withColumn("_shingles", shingle_hashes("_words", width)).drop("_plain", "_words")


def window_minima(shingles: str, wide: int, band: int) -> Column:
    """The least hash, in the band's order, of each window of ``wide`` shingles; windows begin every half of it.

    Windows are two neighbouring runs; what is left at the end of a text counts as a shorter run.
    """
    at, half = F.col(shingles), wide // 2
    runs = F.sequence(F.lit(0), F.greatest(F.size(at) - 1, F.lit(0)), F.lit(half))
    return F.transform(runs, lambda i: F.array_min(F.transform(F.slice(at, i + 1, F.lit(wide)), lambda h: h.bitwiseXOR(F.lit(ORDERS[band])))))


def template_keys(shingles: dict[str, list[int]], wide: int, bands: int) -> dict[int, dict[int, set[str]]]:
    """What windows to look for: by band the value and the templates that have it; -1 for single shingles."""
    out: dict[int, dict[int, set[str]]] = {kind: {} for kind in range(-1, bands)}
    for name, hashes in shingles.items():
        if len(hashes) < wide + wide // 2:
            for h in hashes:
                out[-1].setdefault(h, set()).add(name)
        else:
            for b in range(bands):
                for i in range(len(hashes) - wide + 1):
                    out[b].setdefault(min(h ^ ORDERS[b] for h in hashes[i : i + wide]), set()).add(name)
    return out


def bit_filter(values: list[int]) -> tuple[Column, int]:
    """A literal array of 64-bit words, one a value or more, with a bit for each value and turn, and their number."""
    words = 1 << max(6, min(13, len(values).bit_length()))
    held = [0] * words
    for v in values:
        for turn in TURNS:
            at = v >> turn
            held[at >> 6 & words - 1] |= 1 << (at & 63)
    signed = ",".join(str(w - (1 << 64) if w >> 63 else w) for w in held)
    return F.split(F.lit(signed), ",").cast("array<bigint>"), words


def passing(values: Column, bits: Column, words: int) -> Column:
    """The distinct ``values`` all of whose bits are set."""

    def set_at(v: Column, turn: int) -> Column:
        at = F.shiftright(v, turn)
        word = F.get(bits, F.shiftright(at, 6).bitwiseAND(F.lit(words - 1)).cast("int"))
        return F.bit_get(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1

    return F.array_distinct(F.filter(values, lambda v: reduce(Column.__and__, [set_at(v, turn) for turn in TURNS])))


def scan(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, width: int = WIDTH, wide: int = WIDE, bands: int = BANDS, least: float = LEAST,
    key: str = "doc_id", text: str = "text", telling: dict[str, list[str]] = TELLING,
) -> DataFrame:
    """key, license, n_template (distinct shingles), n_shared and containment, a row per match."""
    spark = docs.sparkSession
    # the templates' own shingles, by the same expressions
    bodies = spark.createDataFrame(list(templates.items()), "license string, body string")
    rows = hashed(bodies.withColumn("plain", plain_words(F.col("body"))), F.col("body"), width).select("license", "plain", "_shingles").collect()
    own = {r["license"]: r["_shingles"] for r in rows}
    keys = template_keys(own, wide, bands)
    table = spark.createDataFrame(
        [(kind, value, name) for kind, values in keys.items() for value, names in values.items() for name in sorted(names)],
        "kind int, value long, license string")
    must = {r["license"]: [[h for i, h in enumerate(r["_shingles"]) if f" {phrase} " in f" {' '.join(r['plain'][i : i + width])} "] for phrase in telling.get(r["license"], [])] for r in rows}
    known = spark.createDataFrame([(n, sorted(set(h)), must[n]) for n, h in own.items()], "license string, _template array<bigint>, _must array<array<bigint>>")

    df = hashed(docs.select(F.col(key).alias("key"), F.col(text).alias("_text")), F.col("_text"), width).drop("_text")
    bits, words = bit_filter([v for values in keys.values() for v in values])
    met = []
    for kind, values in keys.items():
        if values:
            minima = F.col("_shingles") if kind < 0 else window_minima("_shingles", wide, kind)
            named = F.lit(kind).alias("kind")
            met.append(F.transform(passing(minima, bits, words), lambda v: F.struct(named, v.alias("value"))))
    df = df.withColumn("_met", F.concat(*met)) if met else df.withColumn("_met", F.array().cast("array<struct<kind:int,value:bigint>>"))
    # a filter on _met would be pushed below the arrays and compute them anew for each use; a generator's result stays put
    hit = F.explode_outer(F.when(F.size("_met") > 0, F.array(F.struct("_shingles", "_met")))).alias("hit")
    df = df.select("key", hit).where("hit IS NOT NULL").select("key", "hit.*").withColumn("_row", F.monotonically_increasing_id())
    df = settle(df, "licenses")
    pairs = df.select("_row", F.explode("_met").alias("m")).select("_row", "m.kind", "m.value").join(F.broadcast(table), ["kind", "value"])
    pairs = pairs.select("_row", "license").distinct()
    both = pairs.join(df.select("_row", "key", "_shingles"), "_row").join(F.broadcast(known), "license")
    both = both.where(F.forall("_must", lambda m: F.arrays_overlap(m, "_shingles")))
    n, shared = F.size("_template").cast("long"), F.size(F.array_intersect("_template", "_shingles")).cast("long")
    out = both.select(F.col("key").alias(key), "license", n.alias("n_template"), shared.alias("n_shared"))
    return out.withColumn("containment", F.col("n_shared") / F.col("n_template")).where(F.col("containment") >= least)
