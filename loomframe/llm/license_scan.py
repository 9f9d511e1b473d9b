"""License scans: normalised text against license templates by the Dice coefficient of their word bigrams.

A text's units are its lines, its runs of paragraphs, and the text as a whole: a notice that is wrapped over
several lines above or below other text is a run of paragraphs. Sizes count bigrams with repeats, what is shared counts
once. Dice 2|A n B| / (|A| + |B|) cannot reach a bound t unless the smaller side has at least t / (2 - t) of the larger one's
bigrams, so a template is compared only with units whose size lies within these bounds; a count of words shows that before
any bigram is made. By the same bound a unit must hold one of a few words of a template, and texts without any end at once.
All is built-in functions; nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Public license texts and customary notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    ],
    "BSD-2-Clause": [
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ],
    "BSD-3-Clause": [
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ],
    "CC0-1.0": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}
LEAST = 0.85
#: Words that many texts hold; others tell a license sooner.
COMMON = frozenset("a all an and any as at be by can for from in is it not of on or public that the this to under use version with without work you".split())


def bigrams_of(text: str) -> list[str]:
    words = re.sub(r"[^A-Za-z0-9]+", " ", text).lower().split()
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def templates(texts: dict[str, list[str]] = TEMPLATES) -> list[tuple[str, int, int, list[str]]]:
    """(license, number of the template, its size, its bigrams)."""
    return [(name, i, len(g), sorted(set(g))) for name, many in texts.items() for i, t in enumerate(many) if (g := bigrams_of(t))]


def needed_words(known: list[tuple[str, int, int, list[str]]], least: float) -> list[str]:
    """Words of which a unit must contain one to reach `least` with any template.

    Even the smallest unit in bounds must share bound * size of a template's bigrams; once a set of words touches more of
    them than may be missing, a unit without any of these words cannot. Few words are sought: each time the one that brings
    all templates furthest, common ones only where others don't suffice.
    """
    words: set[str] = set()
    # bigrams that no chosen word touches yet, and how many of them must still be touched
    open_ = [[set(grams), math.floor(len(grams) - least / (2 - least) * size) + 1] for _, _, size, grams in known]
    while open_ := [[left, need] for left, need in open_ if need > 0]:
        gain: dict[str, int] = {}
        for left, need in open_:
            touched: dict[str, int] = {}
            for g in left:
                for w in set(g.split()):
                    touched[w] = touched.get(w, 0) + 1
            for w, n in touched.items():
                gain[w] = gain.get(w, 0) + min(n, need)
        best = min(gain, key=lambda w: (w in COMMON or w.isdigit(), -gain[w], -len(w), w))
        words.add(best)
        for o in open_:
            gone = {g for g in o[0] if best in g.split()}
            o[0] -= gone
            o[1] -= len(gone)
    return sorted(words)


def scan(docs: DataFrame, known: list[tuple[str, int, int, list[str]]] | None = None, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, line, lines, license, template, dice): every unit and template with a coefficient of at least `least`.

    A unit is `lines` lines from number `line` on, which counts from 0: one line, a run of paragraphs (lines without a letter
    or digit part them) of any number, as long as its words may reach a template's, or the whole text. Normalised text is lower-case a-z and 0-9, all else one space.
    Null and empty texts and units of fewer than two words match nothing; repeated rows give their matches again; an empty
    table gives none. Other columns are not read.
    """
    known = templates() if known is None else known
    bound = least / (2 - least)
    fits = lambda n, size: (n >= bound * size) & (n * bound <= size)
    # one lower-case copy for all words
    any_word = F.exists(F.array(F.lower("unit")), lambda x: reduce(lambda a, w: a | x.contains(w), needed_words(known, least), F.lit(False)))
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("unit")).where(any_word)
    split = rows.select(F.monotonically_increasing_id().alias("row"), id_col, F.split("unit", "\n").alias("l")).withColumn("n", F.size("l"))
    full = F.transform("l", lambda x: x.rlike("[A-Za-z0-9]"))
    places = F.sequence(F.lit(0), F.col("n") - 1)
    starts = F.filter(places, lambda i: F.get("full", i) & ~F.coalesce(F.get("full", i - 1), F.lit(False)))
    ends = F.filter(places, lambda i: F.get("full", i) & ~F.coalesce(F.get("full", i + 1), F.lit(False)))
    unit = lambda a, n: F.struct(a.alias("line"), n.alias("lines"), F.array_join(F.slice("l", a + 1, n), "\n").alias("unit"))
    ones = F.transform(places, lambda i: F.struct(i.alias("line"), F.lit(1).alias("lines"), F.get("l", i).alias("unit")))
    whole = F.when(F.col("n") > 1, F.array(unit(F.lit(0), F.col("n")))).otherwise(F.array().cast("array<struct<line:int,lines:int,unit:string>>"))
    # one list of sizes, so that a unit's words are counted once, not once for each template
    sizes = sorted({n for k in known for n in range(math.ceil(bound * k[2]), math.floor(k[2] / bound) + 1)})
    most = max(sizes, default=0) + 1  # words of a unit that may match
    split = split.withColumn("full", full).withColumns({"starts": starts, "ends": ends})
    block = F.inline(F.zip_with("starts", "ends", lambda a, e: F.struct(a.alias("line"), e.alias("end"), F.array_join(F.slice("l", a + 1, e - a + 1), "\n").alias("text"))))
    blocks = split.where(F.size("starts") > 0).select("row", id_col, F.col("n").alias("all"), block).withColumn("words", F.regexp_count("text", F.lit("[A-Za-z0-9]+")))
    # paragraphs by the words up to their end: those that a run from one may reach are the next `most` words
    by_row = Window.partitionBy("row")
    blocks = blocks.withColumn("text", F.when(F.col("words") <= most, F.col("text"))).withColumn("upto", F.sum("words").over(by_row.orderBy("line")))
    reach = F.collect_list(F.struct("end", "upto", "text")).over(by_row.orderBy("upto").rangeBetween(0, most))
    run = lambda i: F.struct(F.col("line"), (F.col("reach")[i]["end"] - F.col("line") + 1).alias("lines"), F.array_join(F.transform(F.slice("reach", 1, i + 1), lambda x: x["text"]), "\n").alias("unit"))
    ok = lambda i: (F.col("reach")[i]["upto"] - F.col("upto") + F.col("words") - 1).isin(sizes) & (F.col("reach")[i]["end"] > F.col("line")) & (F.col("reach")[i]["end"] - F.col("line") + 1 < F.col("all"))
    runs = blocks.withColumn("reach", reach).where(F.col("words") <= most).select(id_col, F.inline(F.transform(F.filter(F.sequence(F.lit(0), F.size("reach") - 1), ok), run)))
    units = split.select(id_col, F.inline(F.concat(ones, whole))).union(runs).where(any_word)
    units = units.withColumn("n", F.regexp_count("unit", F.lit("[A-Za-z0-9]+")) - 1).where(F.col("n").isin(sizes))
    words = F.filter(F.split(F.lower(F.regexp_replace("unit", "[^A-Za-z0-9]+", " ")), " "), lambda w: w != "")
    grams = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))
    units = units.select(id_col, "line", "lines", "n", words.alias("w")).select(id_col, "line", "lines", "n", grams.alias("grams"))
    dice = lambda size, g: 2.0 * F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) / (F.col("n") + size)
    each = [F.when(fits(F.col("n"), size), F.struct(F.lit(name).alias("license"), F.lit(i).alias("template"), dice(size, g).alias("dice"))) for name, i, size, g in known]
    none = F.lit(None).cast("struct<license:string,template:int,dice:double>")
    found = units.select(id_col, "line", "lines", F.explode(F.filter(F.array(none, *each), lambda x: x.isNotNull() & (x["dice"] >= least))).alias("m"))
    return found.select(id_col, "line", "lines", "m.license", "m.template", "m.dice")


def sql(known: list[tuple[str, int, int, list[str]]] | None = None, least: float = LEAST) -> str:
    """The same matches as DuckDB SQL over documents."""
    known = templates() if known is None else known
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(n)}, {i}, {size}, [{', '.join(map(quoted, g))}])" for n, i, size, g in known)
    bound = f"{least / (2 - least)!r}e0"
    return f"""
        WITH known(license, template, size, tg) AS (VALUES {rows}),
        lines AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        marks AS (SELECT r, doc_id, l, list_filter(range(len(l)), lambda i: regexp_matches(l[i + 1], '[A-Za-z0-9]')) AS f FROM lines),
        ends AS (SELECT r, doc_id, l, list_filter(f, lambda i: NOT list_contains(f, i - 1)) AS s, list_filter(f, lambda i: NOT list_contains(f, i + 1)) AS e FROM marks),
        paragraphs AS (SELECT r, doc_id, l, unnest(s) AS a, unnest(e) AS z FROM ends),
        counted AS (SELECT *, len(regexp_extract_all(array_to_string(l[a + 1:z + 1], ' '), '[A-Za-z0-9]+')) AS w FROM paragraphs),
        placed AS (SELECT *, sum(w) OVER (PARTITION BY r ORDER BY a) AS upto FROM counted),
        runs AS (SELECT x.doc_id, x.l, x.a AS line, y.z - x.a + 1 AS lines FROM placed x JOIN placed y ON x.r = y.r AND y.a >= x.a
                 WHERE y.upto - x.upto + x.w <= 1 + (SELECT max(size) FROM known) / {bound}),
        units AS (SELECT doc_id, unnest(range(len(l))) AS line, 1 AS lines, unnest(l) AS unit FROM lines
                  UNION ALL SELECT doc_id, line, lines, array_to_string(l[line + 1:line + lines], ' ') FROM runs WHERE lines > 1 AND lines < len(l)
                  UNION ALL SELECT doc_id, 0, len(l), array_to_string(l, ' ') FROM lines WHERE len(l) > 1),
        words AS (SELECT doc_id, line, lines, list_filter(string_split(lower(regexp_replace(unit, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM units),
        grams AS (SELECT doc_id, line, lines, len(w) - 1 AS n, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM words
                  WHERE len(w) > 1 AND len(w) <= 1 + (SELECT max(size) FROM known) / {bound}),
        scored AS (SELECT doc_id, line, lines, license, template, 2e0 * len(list_intersect(g, tg)) / (n + size) AS dice
                   FROM grams JOIN known ON n >= {bound} * size AND n * {bound} <= size)
        SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(lines AS INTEGER) AS lines, license, CAST(template AS INTEGER) AS template, CAST(dice AS DOUBLE) AS dice FROM scored WHERE dice >= {least!r}e0"""
