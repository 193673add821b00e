"""License scans by diagonal voting, with DataFrame functions only.

Every text becomes its words; all rolling runs of `K` words are hashed and joined to the hashed runs of the
license templates (a broadcast side of fixed size: the texts below). A match at word p of a text and word t of
a template votes for the diagonal p - t. Votes are summed by text, template and diagonal; diagonals that lie
within `DRIFT` words of their neighbour are merged, which lets spans bridge words put in or left out. A merged
span is then verified by alignment: its matches, in the order of the text, are read as chains in which the
template's words go forward and the gaps of both sides differ by `DRIFT` words at most; the span is its longest
chain, and a license if that holds `COVER` of the template's runs.

Licenses are given by their whole texts where these are short, else by the notices that their authors ask to
put into files. Each paragraph is a template of its own, so that a text which quotes a part is found, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 3
#: Words by which neighbouring diagonals of one span, and gaps of one chain, may differ.
DRIFT = 4
#: Share of a template's runs that a span's chain has to show.
COVER = 0.6
#: Words of the shortest template.
SHORTEST = 5

# Texts and notices of well-known licenses, paragraphs apart; and the phrases of the base labels.
TEMPLATES = {
    "mit": """Released under the MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache": """Licensed under the Apache License, Version 2.0

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl": """This work is licensed under the GNU General Public License, version

This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "lgpl": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "agpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

This notice may not be removed or altered from any source distribution.""",
    "boost": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    "cc-by": """This work is licensed under a Creative Commons Attribution 4.0 International License

Licensed under CC BY 4.0""",
    "cc-by-sa": """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License

Licensed under CC BY-SA 4.0""",
    "cc-by-nc": """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License

Licensed under CC BY-NC 4.0""",
}
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-case words: digits, letters and everything beyond ASCII; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(low, _GAPS), lambda w: w != "")


def _runs(words: str, place: str) -> list[Column]:
    """The K words of column `words` from a place on."""
    return [F.get(words, F.col(place) + i) for i in range(K)]


def _template_runs(spark: SparkSession) -> DataFrame:
    """label, part (paragraph), t, h and run of each run of each template, and how many runs the template has."""
    parts = [(label, i, part) for label, body in TEMPLATES.items() for i, part in enumerate(body.split("\n\n"))]
    rows = spark.createDataFrame(parts, "label string, part int, body string").select("label", "part", words_of(F.col("body")).alias("w")).where(F.size("w") >= SHORTEST)
    at = rows.select("label", "part", "w", F.posexplode("w").alias("t", "word")).where(F.col("t") <= F.size("w") - K)
    return at.select("label", "part", "t", F.xxhash64(*_runs("w", "t")).alias("h"), F.concat_ws(" ", *_runs("w", "t")).alias("run"), (F.size("w") - K + 1).alias("runs"))


def _longest_chain(matches: Column) -> Column:
    """The longest chain (n, a, b: runs, and places of the first and last) of matches (p, t) sorted by p and t."""
    chain = "struct<n:int,a:int,b:int>"
    start = F.expr(f"named_struct('best', CAST(named_struct('n', 0, 'a', 0, 'b', 0) AS {chain}), 'now', CAST(named_struct('n', 0, 'a', 0, 'b', 0) AS {chain}), 't', -1)")

    def step(acc: Column, m: Column) -> Column:
        now = acc["now"]
        goes_on = (now["n"] > 0) & (m["t"] > acc["t"]) & (F.abs((m["p"] - now["b"]) - (m["t"] - acc["t"])) <= DRIFT)
        again = (now["n"] > 0) & (m["p"] == now["b"])  # a second place of the template for the same words
        longer = F.struct((now["n"] + 1).alias("n"), now["a"].alias("a"), m["p"].alias("b"))
        new = F.struct(F.lit(1).alias("n"), m["p"].alias("a"), m["p"].alias("b"))
        then = F.when(again, now).when(goes_on, longer).otherwise(new)
        best = F.when(then["n"] > acc["best"]["n"], then).otherwise(acc["best"])
        return F.struct(best.alias("best"), then.alias("now"), F.when(again, acc["t"]).otherwise(m["t"]).alias("t"))

    return F.aggregate(matches, start, step, lambda acc: acc["best"])


def license_spans(docs: DataFrame) -> DataFrame:
    """label, part, first_word, last_word, cover (share of the template's runs) of each verified span of docs (r1, r2, w), which keep r1 and r2."""
    runs = _template_runs(docs.sparkSession)
    at = docs.select("r1", "r2", "w", F.posexplode("w").alias("p", "word")).where(F.col("p") <= F.size("w") - K)
    hits = at.select("r1", "r2", "p", F.xxhash64(*_runs("w", "p")).alias("h"), F.concat_ws(" ", *_runs("w", "p")).alias("run")).join(F.broadcast(runs), ["h", "run"])
    one = ["r1", "r2", "label", "part", "runs"]
    lanes = hits.groupBy(*one, (F.col("p") - F.col("t")).alias("diagonal"), F.floor(F.col("p") / 1024).alias("piece")).agg(F.min("p").alias("a"), F.collect_set("t").alias("t"))
    near = W.partitionBy(*one[:4]).orderBy("diagonal", "a")
    step = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(near) > DRIFT).cast("int"), F.lit(0))
    lanes = lanes.withColumn("step", step).withColumn("span", F.sum("step").over(near))
    of_lane = F.transform("t", lambda t: F.struct((t + F.col("diagonal")).cast("int").alias("p"), t.alias("t")))
    spans = lanes.groupBy(*one, "span").agg(F.array_sort(F.flatten(F.collect_list(of_lane))).alias("matches"))
    spans = spans.where(F.size("matches") >= COVER * F.col("runs")).withColumn("chain", _longest_chain(F.col("matches")))
    cover = F.col("chain.n") / F.col("runs")
    return spans.where(cover >= COVER).select("r1", "r2", "label", "part", F.col("chain.a").cast("long").alias("first_word"), (F.col("chain.b") + K - 1).cast("long").alias("last_word"), cover.alias("cover"))


def _stands(words: Column, parts: list[str]):
    """Whether the parts stand at a place."""

    def at(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return found

    return at


def base_phrases(words: Column) -> dict[str, Column]:
    """For each phrase the sorted places where its words stand one after the other; for texts with words."""
    return {phrase: F.filter(F.sequence(F.lit(0), F.size(words) - 1), _stands(words, phrase.split())) for phrase in PHRASES}


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans: one row per row of docs (doc_id, text).

    Null and empty texts have no words, labels '' and null places. Repeated rows each get their row; null
    ids are kept. The score is the best cover of a template, or 1 where a base phrase stands. Rows and their spans
    meet by two digests of id and text, which equal rows share, so no number of a scan is needed.
    """
    ids = F.col("doc_id").cast("long")
    text = docs.select(ids.alias("doc_id"), F.xxhash64(F.lit(1), ids, "text").alias("r1"), F.xxhash64("text", ids.isNull(), ids, F.lit(2)).alias("r2"), words_of(F.col("text")).alias("w"))
    places = base_phrases(F.col("w"))
    # Only texts with the word are looked at place by place.
    has = F.array_contains("w", "license")
    none = F.expr("CAST(array() AS array<int>)")
    counted = text.select("r1", "r2", "doc_id", F.size("w").cast("long").alias("n_words"), *(F.when(has, p).otherwise(none).alias(f"p{i}") for i, p in enumerate(places.values())))
    every = F.array_sort(F.concat(*(F.col(f"p{i}") for i in range(len(places)))))
    named = F.filter(F.array(*(F.when(F.size(f"p{i}") > 0, F.lit(x)) for i, x in enumerate(PHRASES.values()))), lambda x: x.isNotNull())
    summary = counted.select("r1", "r2", "doc_id", "n_words", every.alias("at"), F.array_sort(named).alias("base"))
    span = F.struct("label", "part", "first_word", "last_word", "cover")
    found = license_spans(text).groupBy("r1", "r2").agg(F.collect_set("label").alias("more"), F.max("cover").alias("cover"), F.array_sort(F.collect_list(span)).alias("spans"))
    both = summary.join(found, ["r1", "r2"], "left")
    empty = F.expr("CAST(array() AS array<string>)")
    return both.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"), F.get("at", F.lit(0)).cast("long").alias("first_word"), F.get("at", F.size("at") - 1).cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", empty))), ",").alias("labels"),
        F.when(F.size("at") > 0, F.lit(1.0)).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"), "spans",
    )
