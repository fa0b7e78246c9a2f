"""License scans: whole texts compared with licence templates by Dice coefficient of word bigrams.

Main path: DataFrame functions only, without a shuffle. A text is normalised (lower case,
everything but letters and digits becomes a space) and cut into word bigrams, over line ends.
Where a bigram of a template stands, a window of as many bigrams as the template has (fewer at
the end of the text) is compared with it: 2 * common / (distinct in the window + in the template).
A text's best window (then its first) counts for each template, if it reaches the threshold t.

Pruning, which loses nothing: a window must share at least t / (2 - t) of the template's distinct
bigrams (the size bound), so
1. a text without any of a few words that touch too many of each template's bigrams goes first;
2. a template goes that shares fewer distinct bigrams with the whole text (a text that is too
   short for a template is among these);
3. a window goes that begins fewer positions with bigrams of the template.

The templates are a fixed list of notices and licence texts, given as a parameter, so they are
literals of the plan.

Defined results: null, empty and one-word texts match nothing; a row for each template that is
reached; repeated rows are reported each; an empty table or template list gives none; very long
texts are read to their end; other columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Short notices by which texts state their licence, and the texts of short licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-released": "Released under the BSD License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction'
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "proprietary": "All rights reserved.",
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
        'specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
        "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, "
        "OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
        "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must "
        "be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
        "altered from any source distribution."
    ),
}

_SEPARATOR = r"[^\p{L}\p{N}]+"


def normalised_words(text: str) -> list[str]:
    """What ``_words`` does on the JVM, for the templates."""
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def needed(found: list[str], threshold: float) -> int:
    """How many of a template's bigrams a window must hold to reach the threshold."""
    return max(1, math.ceil(threshold * len(found) / (2 - threshold) - 1e-9))


def anchors(known: dict[str, list[str]], threshold: float) -> list[str]:
    """Words of which every text that reaches a template has one.

    Chosen greedily until fewer of each template's bigrams than needed lack them; the longest
    words, taken as the rarest, come first.
    """
    left = {name: set(found) for name, found in known.items()}
    chosen: list[str] = []
    while True:
        over = {name: len(left[name]) - needed(known[name], threshold) + 1 for name in known}
        gain: dict[str, float] = {}
        for name in known:
            for pair in left[name] if over[name] > 0 else ():
                for w in set(pair.split(" ")):
                    gain[w] = gain.get(w, 0.0) + 1 / over[name]
        if not gain:
            return sorted(chosen)
        word = min(gain, key=lambda w: (len(w) < 6, -gain[w] * len(w), w))
        chosen.append(word)
        left = {name: {pair for pair in pairs if word not in pair.split(" ")} for name, pairs in left.items()}


def _pairs(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def _best(pairs: Column, template: Column) -> Column:
    """(dice, -start) of the best window, null if none holds enough of the template's bigrams."""
    found, span, need = template["found"], template["span"], template["need"]
    hits = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda p: F.array_contains(found, F.get(pairs, p)))

    def window(p: Column) -> Column:
        own = F.array_distinct(F.slice(pairs, p + 1, span))
        dice = 2.0 * F.size(F.array_intersect(own, found)) / (F.size(own) + F.size(found))
        return F.struct(dice.alias("dice"), (-p).alias("minus"))

    dense = F.transform(F.array(hits), lambda h: F.filter(h, lambda p, i: F.coalesce(F.get(h, i + need - 1) - p < span, F.lit(False))))
    return F.array_max(F.transform(F.get(dense, F.lit(0)), window))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license, start, n_words, dice) of each text and template that it reaches.

    ``start`` is the best window's first word, from 0, and ``n_words`` its length.
    """
    spark = docs.sparkSession
    spans, known = {}, {}
    for name, text in sorted((TEMPLATES if templates is None else templates).items()):
        words = normalised_words(text)
        if len(words) > 1:
            spans[name], known[name] = len(words) - 1, bigrams(words)
    if not known:
        return spark.createDataFrame([], f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, license string, start int, n_words int, dice double")

    strings = lambda xs: F.array(*map(F.lit, xs))
    rows = [
        F.struct(F.lit(name).alias("license"), F.lit(spans[name]).alias("span"), F.lit(needed(found, threshold)).alias("need"), strings(found).alias("found"))
        for name, found in known.items()
    ]
    every = strings(sorted({pair for found in known.values() for pair in found}))
    anchored = r"(?<![\p{L}\p{N}])(?:" + "|".join(anchors(known, threshold)) + r")(?![\p{L}\p{N}])"

    texts = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("text")).filter(F.col("text").rlike(anchored))
    worded = texts.select("id", F.split(F.trim(F.regexp_replace("text", _SEPARATOR, " ")), " ").alias("words"))
    paired = worded.select("id", F.explode(F.array(_pairs(F.col("words")))).alias("pairs"))
    shared = paired.select("id", "pairs", F.explode(F.array(F.array_intersect("pairs", every))).alias("shared"))
    reached = F.filter(F.array(*rows), lambda t: F.size(F.array_intersect(F.col("shared"), t["found"])) >= t["need"])
    tried = shared.select("id", "pairs", F.explode(reached).alias("t"))
    scored = tried.select("id", "t.license", "t.span", F.size("pairs").alias("size"), F.explode(F.array(_best(F.col("pairs"), F.col("t")))).alias("best"))
    scored = scored.filter(F.col("best.dice") >= threshold)
    start = -F.col("best.minus")
    return scored.select(F.col("id").alias(id_col), "license", start.alias("start"), (F.least("span", F.col("size") - start) + 1).alias("n_words"), F.col("best.dice").alias("dice"))
