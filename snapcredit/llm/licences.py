"""Licence scans: Dice coefficient over word bigrams against licence templates, in built-in functions."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import let

#: Notices and texts of public licences, and short statements in common use.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright to this work under CC0 1.0.",
    "reserved": "All rights reserved.",
}
#: Least Dice coefficient of a match.
THRESHOLD = 0.9
#: Templates from this many words on are looked for inside a text, whatever its lines; shorter ones as sentences.
WINDOW_WORDS = 20
#: Words, one of which a text must hold before the many anchors of a template are looked for, where that loses nothing.
SIGNS = ("license", "software", "copyright", "warranties", "damages")
#: Ends of sentences and paragraphs, of no width: the pieces make up the text.
SENTENCES = r"(?<=[.!?;])(?=\s)|(?=\n[ \t]*\n)"


def template_words(text: str) -> list[str]:
    """Words of a template, normalised like texts."""
    return re.sub(r"[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split()


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template."""
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def normalised_words(text: Column) -> Column:
    """Runs of letters a-z, A-Z and digits in lower case; all else separates."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    return F.array_distinct(
        F.zip_with(
            F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
            F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
    )


def match_passage(passage: Column, templates: Mapping[str, list[str]], threshold: float) -> Column:
    """Best template of a passage as struct (dice, licence), null if none reaches the threshold.

    With n and m distinct bigrams the coefficient is at most 2 min(n, m) / (n + m), so a template is
    compared only if m lies between t n / (2 - t) and n (2 - t) / t. The same bound comes before bigrams are
    made: a passage has at most one less than it has words, at least one less than it has distinct words.
    """
    words = normalised_words(passage)

    def possible(w: Column, distinct: Column) -> Column:
        fits = [
            ((F.size(w) - 1) * (2 - threshold) >= len(own) * threshold)
            & ((F.size(distinct) - 1) * threshold <= len(own) * (2 - threshold))
            for own in templates.values()
        ]
        return reduce(lambda x, y: x | y, fits)

    def compare(grams: Column) -> Column:
        n = F.size(grams)

        def one(name: str, own: list[str]) -> Column:
            m = len(own)
            near = (n * threshold <= m * (2 - threshold)) & (m * threshold <= n * (2 - threshold))
            shared = F.size(F.array_intersect(grams, F.array(*(F.lit(b) for b in own))))
            dice = 2 * shared / (n + m)
            return F.when(near, F.struct(dice.alias("dice"), F.lit(name).alias("licence")))

        found = F.array(*(one(name, own) for name, own in templates.items()))
        # Of equal coefficients the licence first in alphabetical order.
        return F.aggregate(
            F.filter(found, lambda x: x["dice"] >= threshold),
            F.lit(None).cast("struct<dice:double,licence:string>"),
            lambda best, x: F.when(
                best.isNull() | (x["dice"] > best["dice"]) | ((x["dice"] == best["dice"]) & (x["licence"] < best["licence"])),
                x,
            ).otherwise(best),
        )

    return let(
        words,
        lambda w: let(
            F.array_distinct(w), lambda distinct: F.when(possible(w, distinct), let(bigrams(w), compare))
        ),
    )


def anchors(words: list[str], least: int, size: int) -> dict[int, list[str]]:
    """Places and words of `least` strings of `size` words that share no bigram, spread evenly over the template."""
    step = max(size - 1, (len(words) - size) // max(least - 1, 1))
    return {at: words[at : at + size] for at in range(0, len(words) - size + 1, step)}


def window_match(words: Column, name: str, template: str, threshold: float) -> Column:
    """Best window of the template's length as struct (dice, licence, start, size), null below the threshold.

    A window of that length which reaches the threshold lacks at most m (1 - t) of m bigrams, so it holds one
    of so many and one more anchors; windows are laid where an anchor puts the start.
    """
    own, body = template_bigrams(template), template_words(template)

    def starts(at: int, grams: list[str]) -> Column:
        def here(i: Column) -> Column:
            return reduce(lambda x, y: x & y, [F.get(words, i + k) == w for k, w in enumerate(grams)])

        places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
        return F.transform(places, lambda i: F.greatest(i - at, F.lit(0)))

    hits = [starts(at, grams) for at, grams in anchors(body, int(len(own) * (1 - threshold)) + 1, 3).items()]

    def measured(start: Column) -> Column:
        return let(
            bigrams(F.slice(words, start + 1, F.lit(len(body)))),
            lambda grams: F.struct(
                (
                    2 * F.size(F.array_intersect(grams, F.array(*(F.lit(b) for b in own)))) / (F.size(grams) + len(own))
                ).alias("dice"),
                # Of equal windows the one that begins like the template, then the first.
                (F.get(words, start) == body[0]).alias("begins"),
                (-start).alias("before"),
            ),
        )

    best = F.array_max(F.transform(F.array_distinct(F.flatten(F.array(*hits))), measured))
    return let(
        best,
        lambda b: F.when(
            b["dice"] >= threshold,
            F.struct(
                b["dice"].alias("dice"), F.lit(name).alias("licence"), (-b["before"]).alias("start"),
                F.lit(len(body)).alias("size"),
            ),
        ),
    )


def inner_matches(body: Column, templates: Mapping[str, str], threshold: float) -> Column:
    """Licences stated inside a text as structs (line, licence, dice): sentences, and windows over its lines."""
    words_of = {name: template_words(t) for name, t in templates.items()}
    long = {name: t for name, t in templates.items() if len(words_of[name]) >= WINDOW_WORDS}
    grams = {n: template_bigrams(t) for n, t in templates.items() if n not in long and len(words_of[n]) > 1}
    entry = "array<struct<line:int,licence:string,dice:double>>"

    def holds(flat: Column, words: list[str], least: int, size: int) -> Column:
        found = [F.contains(flat, F.lit(f" {' '.join(w)} ")) for w in anchors(words, least, size).values()]
        return reduce(lambda x, y: x | y, found)

    def windows(flat: Column, signed: Column) -> Column:
        # Which words stand on which line is only needed of texts with a match.
        words = F.split(F.trim(flat), " ")

        def one(name: str, t: str) -> Column:
            own = template_bigrams(t)
            least = int(len(own) * (1 - threshold)) + 1
            best = let(words, lambda w: window_match(w, name, t, threshold))
            near = holds(flat, words_of[name], least, 3)
            # A window without any of the signs lacks all bigrams that have one.
            if sum(not set(SIGNS).isdisjoint(b.split()) for b in own) >= least:
                near = signed & near
            return F.when(near, best)

        found = F.array(*(one(name, t) for name, t in long.items()))

        def alone(found: Column) -> Column:
            def beaten(x: Column) -> Column:
                return F.exists(found, lambda y: (y["dice"] > x["dice"]) & (F.abs(y["start"] - x["start"]) < x["size"]))

            return F.filter(found, lambda x: ~beaten(x))

        def line(start: Column) -> Column:
            counts = F.transform(F.split(body, "\n"), lambda x: F.size(normalised_words(x)))
            through = F.aggregate(
                counts,
                F.struct(F.lit(0).alias("words"), F.lit(0).alias("line")),
                lambda acc, n: F.struct(
                    (acc["words"] + n).alias("words"),
                    F.when(acc["words"] + n <= start, acc["line"] + 1).otherwise(acc["line"]).alias("line"),
                ),
            )
            return through["line"]

        kept = let(F.filter(found, lambda x: x.isNotNull()), alone)
        return F.transform(
            kept,
            lambda x: F.struct(line(x["start"]).alias("line"), x["licence"].alias("licence"), x["dice"].alias("dice")),
        ).cast(entry)

    def sentences(_: Column) -> Column:
        def matched(pieces: Column) -> Column:
            def line(at: Column) -> Column:
                before = F.array_join(F.slice(pieces, 1, at), "")
                # The first line on which the piece has more than blanks.
                before = F.concat(before, F.regexp_extract(F.get(pieces, at), r"^(\s*)", 1))
                return F.char_length(before) - F.char_length(F.replace(before, F.lit("\n"), F.lit("")))

            each = F.transform(
                pieces, lambda p, i: F.struct(i.alias("at"), match_passage(p, grams, threshold).alias("best"))
            )
            return F.transform(
                F.filter(each, lambda m: m["best"].isNotNull()),
                lambda m: F.struct(
                    line(m["at"]).alias("line"), m["best"]["licence"].alias("licence"), m["best"]["dice"].alias("dice")
                ),
            ).cast(entry)

        return let(F.split(body, SENTENCES), matched)

    none = F.array().cast(entry)

    def both(flat: Column) -> Column:
        parts = []
        if grams:
            # A passage that matches has at least t / (2 - t) of the bigrams.
            near = [
                holds(flat, words_of[n], int(len(own) * (1 - threshold / (2 - threshold))) + 1, 2)
                for n, own in grams.items()
            ]
            parts.append(F.when(reduce(lambda x, y: x | y, near), sentences(flat)).otherwise(none))
        if long:
            signed = reduce(lambda x, y: x | y, [F.contains(flat, F.lit(f" {w} ")) for w in SIGNS])
            parts.append(let(signed, lambda any_sign: windows(flat, any_sign)))
        return F.concat(*parts) if parts else none

    flat = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(body), "[^a-z0-9]+", " ")), F.lit(" "))
    return let(flat, both)


def scan_licences(
    docs: DataFrame,
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All rows and columns of `docs` with the licences that the text, one of its lines or a part of it states.

    Passages are the whole text and each of its lines, in lower case with all but letters a-z and digits
    as separators. A passage matches the template with the largest Dice coefficient over distinct word
    bigrams, from `threshold` on; ties go to the first name. Adds licences (struct of line, from 0 or -1
    for the whole text, licence and dice, in order of line); a text of one line is listed once, as whole
    text. Null and empty texts have none. Templates of fewer than two words are left out. A column named
    licences is replaced. One projection of built-in functions; nothing is shuffled.

    A licence that neither the text nor a line states is also looked for inside the text, and listed once
    with the line it begins on, after the others: short templates as a sentence (from or to a full stop or a
    blank line, wrapped or not), templates of WINDOW_WORDS words or more as a window of their length over
    the words of all lines. Of windows that overlap the best one counts.
    """
    grams = {name: own for name, body in templates.items() if (own := template_bigrams(body))}
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(body, "\n")

    def passages(lines: Column) -> Column:
        each = F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("passage")))
        whole = F.array(F.struct(F.lit(-1).alias("line"), body.alias("passage")))
        return F.concat(whole, F.when(F.size(lines) > 1, each).otherwise(F.slice(each, 1, 0)))

    matched = F.transform(
        passages(lines),
        lambda p: F.struct(p["line"].alias("line"), match_passage(p["passage"], grams, threshold).alias("best")),
    )
    found = F.transform(
        F.filter(matched, lambda m: m["best"].isNotNull()),
        lambda m: F.struct(m["line"].alias("line"), m["best"]["licence"].alias("licence"), m["best"]["dice"].alias("dice")),
    )

    def with_inner(found: Column) -> Column:
        names = F.transform(found, lambda x: x["licence"])

        def further(inner: Column) -> Column:
            earlier = F.filter(
                inner,
                lambda x, i: ~F.array_contains(names, x["licence"])
                & (F.array_position(F.transform(inner, lambda y: y["licence"]), x["licence"]) == i + 1),
            )
            return F.concat(found, earlier)

        return let(inner_matches(body, templates, threshold), further)

    return docs.withColumn("licences", let(found, with_inner))
