"""Licence scans by a positional rare-token index, with DataFrame operations only.

Each template's words, but for function words, are index keys with their positions as postings. One reading of the texts finds the keys that each file holds and how many files hold each key. A file whose keys could make up AGREE of a template's is then looked up: hits of the template's rarest postings (by IDF over all files; so many that a template which agrees must have one of them hit) say where in the file the template might begin, and all its postings are intersected with the file's words at those shifts. Whole licences are matched with a drift of DRIFT words, since names and years come between their words; notices are matched to the word. A template labels a file if AGREE of its postings agree on a shift and its mandatory phrases stand where the template does. All of it happens within a row: no text moves.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import ascii_lower, once, stored, table

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Words that are no keys.
COMMON = frozenset("a and any are as be by for from in is it may not of on or the this that to with without under you your 0 1 2 3 4 v".split())
#: Share of a template's postings that must agree on one shift; words of a whole licence that may come between; words about a template in which its phrases are looked for.
AGREE, DRIFT, SLACK = 0.6, 16, 6

#: Whole licences.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_3 = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
EPL = """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""
BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"""
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."

#: Label, text, mandatory phrases.
TEXTS = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("apache-2.0", APACHE, ["apache license", "version 2 0"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge", "obtaining a copy of this software"]),
    ("mit", MIT, ["permission is hereby granted free of charge", "obtaining a copy of this software"]),
    ("isc", "released under the isc license", ["isc license"]),
    ("isc", ISC, ["permission to use copy modify", "with or without fee is hereby granted"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-2.0", GNU.format("General Public License", "2"), ["gnu general public license", "version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-3.0", GNU.format("General Public License", "3"), ["gnu general public license", "version 3"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("lgpl", GNU.format("Lesser General Public License", "3"), ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["affero general public license"]),
    ("agpl", GNU.format("Affero General Public License", "3"), ["affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    ("bsd", BSD_2, ["redistribution and use in source and binary forms"]),
    ("bsd-3-clause", BSD_3, ["neither the name of", "endorse or promote products"]),
    ("bsd", "released under the bsd license", ["bsd license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("mpl-2.0", MPL, ["mozilla public license"]),
    ("epl-2.0", EPL, ["eclipse public license"]),
    ("boost-1.0", "distributed under the boost software license version 1 0", ["boost software license"]),
    ("boost-1.0", BOOST, ["permission is hereby granted free of charge", "person or organization obtaining a copy"]),
    ("unlicense", UNLICENSE, ["unencumbered software released into the public domain"]),
    ("zlib", ZLIB, ["as is without any express or implied warranty", "must not be misrepresented"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ["cc by nd 4 0"]),
    ("cc-by", "licensed under a creative commons attribution license", ["creative commons attribution"]),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ["cc0 1 0"]),
    ("reserved", "copyright all rights reserved", ["all rights reserved"]),
]


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]

    @cached_property
    def words(self) -> list[str]:
        return re.sub(GAP, " ", self.text.lower()).split()

    @cached_property
    def postings(self) -> list[tuple[str, int]]:
        return [(w, i) for i, w in enumerate(self.words) if w not in COMMON]

    @property
    def drift(self) -> int:
        return DRIFT if len(self.words) > 2 * DRIFT else 1

    @property
    def least(self) -> int:
        """Postings that must agree."""
        return max(1, math.ceil(AGREE * len(self.postings) - 1e-9))


TEMPLATES = [Template(label, text, tuple(phrases)) for label, text, phrases in TEXTS]
LEXICON = sorted({w for t in TEMPLATES for w, _ in t.postings})
#: A word of each base phrase; rows without any have no places of them.
ANCHORS = " (?:license|cc|rights) "


def normal(text: Column) -> Column:
    """Words joined by single spaces; null counts as empty."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), GAP, " "))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" ")))


def _list(words) -> Column:
    return F.from_json(F.lit(json.dumps(list(words))), "array<string>")


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def read_once(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base (labels), held (keys) of every row, and the normalised text of rows whose keys could make up a template."""
    rows = once(docs.select("doc_id", F.col("text").cast("string").alias("text")), padded=F.concat(F.lit(" "), normal(F.col("text")), F.lit(" "))).drop("text")
    rows = rows.withColumn("n_words", F.when(F.col("padded") == "  ", 0).otherwise(_spaces(F.col("padded")) - 1).cast("long"))
    rows = once(rows, near=F.col("padded").rlike(ANCHORS), held=F.array_intersect(_list(LEXICON), F.split("padded", " ")))
    firsts, lasts, numbers, marks = [], [], [], []
    for phrase, label in BASE.items():
        has = F.col("near") & F.contains("padded", F.lit(f" {phrase} "))
        pieces = F.split("padded", f"(?<= ){phrase}(?= )")
        numbers.append(F.when(has, F.size(pieces) - 1).otherwise(0))
        firsts.append(F.when(has, _spaces(F.get(pieces, F.lit(0))) - 1))
        lasts.append(F.when(has, F.col("n_words") - _spaces(F.element_at(pieces, -1)) - phrase.count(" ")))
        marks.append(F.when(has, F.lit(label)))
    # distinct keys of a template that a file must hold at least: its postings that must agree, without the repeated ones
    needed = [(sorted({w for w, _ in t.postings}), t.least - (len(t.postings) - len({w for w, _ in t.postings}))) for t in TEMPLATES]
    able = (F.size("held") > 0) & _any([F.size(F.array_intersect("held", _list(keys))) >= max(1, n) for keys, n in needed])
    base = {"n_base": sum(numbers[1:], numbers[0]).cast("long"), "first_word": F.least(*firsts).cast("long"), "last_word": F.greatest(*lasts).cast("long"), "base": F.array_compact(F.array(*marks))}
    return rows.select("doc_id", "n_words", *(c.alias(n) for n, c in base.items()), "held", F.when(able, F.col("padded")).alias("padded"))


def document_counts(rows: DataFrame) -> dict[str, int]:
    """Number of all rows that hold each key; a row a key reaches the driver."""
    return {r[0]: r[1] for r in rows.select(F.explode("held").alias("w")).groupBy("w").count().collect()}


def _found(t: Template, idf: dict[str, float]) -> Column:
    """struct(label, share) if the template agrees with the row's hits (array of struct w, i) and its phrases stand there, else null."""
    rarest = sorted(t.postings, key=lambda p: (-idf[p[0]], p))[: len(t.postings) - t.least + 1]

    def shifts(postings: list[tuple[str, int]]) -> Column:
        """struct(band, place in the template) of each hit of the postings; bands of drift shifts overlap by half."""
        by: dict[str, list[int]] = {}
        for w, i in postings:
            by.setdefault(w, []).append(i)
        index = F.from_json(F.lit(json.dumps(by)), "map<string,array<int>>")
        step = max(1, t.drift // 2)
        bands = (lambda s: [F.floor(s / step).cast("int"), F.floor(s / step).cast("int") - 1]) if t.drift > 1 else (lambda s: [s])
        own = F.filter("hits", lambda h: F.array_contains(_list(sorted(by)), h["w"]))
        at = F.flatten(F.transform(own, lambda h: F.flatten(F.transform(F.element_at(index, h["w"]), lambda p: F.array(*(F.struct(b.alias("band"), p.alias("p")) for b in bands(h["i"] - p)))))))
        return F.array_distinct(at)

    zero = F.struct(F.lit(None).cast("int").alias("band"), F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(0).alias("at"))

    def tally(acc: Column, x: Column) -> Column:
        run = F.when(acc["band"].eqNullSafe(x["band"]), acc["run"] + 1).otherwise(1)
        return F.struct(x["band"].alias("band"), run.alias("run"), F.greatest(acc["best"], run).alias("best"), F.when(run > acc["best"], x["band"]).otherwise(acc["at"]).alias("at"))

    seeds = F.transform(shifts(rarest), lambda x: x["band"])
    best = F.aggregate(F.sort_array(F.filter(shifts(t.postings), lambda x: F.array_contains(seeds, x["band"]))), zero, tally)
    start = best["at"] * max(1, t.drift // 2) - SLACK
    window = F.slice("words", F.greatest(F.lit(0), start) + 1, F.lit(len(t.words) + t.drift + 2 * SLACK))
    text = F.concat(F.lit(" "), F.array_join(window, " "), F.lit(" "))
    stands = ~_any([~F.contains(text, F.lit(f" {p} ")) for p in t.phrases])
    return F.when((F.size(seeds) > 0) & (best["best"] >= t.least) & stands, F.struct(F.lit(t.label).alias("label"), (best["best"] / len(t.postings)).alias("share")))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs (doc_id, text; others are ignored).

    Null and empty texts have 0 words, no labels (empty strings), score 0 and null places. Repeated rows give repeated results; an empty table gives none. score: the largest share of a labelled template's postings that agree on one shift; 0.5 if there are base labels only; else 0.
    """
    rows = stored(read_once(docs), "held")
    counts, total = document_counts(rows), rows.count()
    idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in LEXICON}
    some = F.col("padded").isNotNull()
    ranked = F.array_intersect(_list(sorted(LEXICON, key=lambda w: (-idf[w], w))), "held")  # the file's licence words, rarest first
    rows = once(rows, words=F.when(some, F.split(F.trim("padded"), " ")), ranked=F.when(some, ranked))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains("ranked", x["w"]))
    rows = once(rows, hits=F.when(some, hits))
    rows = once(rows, found=F.when(some, F.array_compact(F.array(*(_found(t, idf) for t in TEMPLATES)))))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce(F.col("found.label"), F.array().cast("array<string>")))))
    score = F.coalesce(F.array_max(F.col("found.share")), F.when(F.size("base") > 0, 0.5), F.lit(0.0))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.cast("double").alias("score"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document; see scanned() for nulls, empty texts and repeated rows."""
    return scanned(table(spark, sf_dir, "documents"))
