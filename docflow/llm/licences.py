"""Licence scans by sentence rules, in SQL functions only.

A text is cut into pieces at line ends and sentence ends, normalised to
lower-case words. From each piece on, a run of pieces (a sentence may be wrapped
over lines of any width) grows while it begins some known sentence; the longest
known sentence that it spells is mapped to its identifier. A sentence inside a
longer known one does not count. Names of holders (``SLOTS``) become one word.
What a text holds is then a sequence of identifiers, unknown sentences left out.
Rules are tried in their order, longer texts first; a rule that matches takes
its sentences, which later rules no longer see.

Everything happens inside a row: no shuffle, and texts without a word of
``HINTS`` (every known sentence has one) are not cut at all.

Defined results: a null or empty text and a text without a rule give no row;
every match of a rule in a text is counted and the first is placed (counted in
pieces from 0; the lines that a holder's name spans are one piece); repeated
rows give repeated results; the new columns replace those of their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import free_name

#: Words, or beginnings of words, of which every known sentence has one.
HINTS = ("license", "licence", "permission", "permitted", "redistribut", "warrant", "copyright", "copies", "liable",
         "liability", "software", "domain", "released")

#: Places for a holder's name, (words before, words after).
SLOTS = (
    ("neither the name of", "nor the names of"),
    ("in no event shall", "be liable for any"),
    ("this software is provided by", "as is and any express"),
    ("in this notice the name of", "shall not be used in advertising"),
)

#: Most words of a holder's name, and the word that stands for it.
SLOT_WORDS, HOLDER = 16, "holder"

#: Known licence sentences by identifier.
TEXTS = {
    "mit-title": "The MIT License (MIT)",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."),
    "as-is-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "mit-liable": (
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE."),
    "x11-name": (
        "Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise "
        "to promote the sale, use or other dealings in this Software without prior written authorization from the X "
        "Consortium."),
    "0bsd-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted."),
    "isc-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "apache-2": "Licensed under the Apache License, Version 2.0.",
    "apache-2-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License."),
    "apache-2-obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-2-basis": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "gpl-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "gpl-2-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "gpl-no-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "lgpl-2-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."),
    "lgpl-3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "lgpl-no-warranty": (
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "agpl-3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "gpl-2-exactly": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation."),
    "gpl-3-exactly": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 3 as published by the Free Software Foundation."),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "bsd-provided": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."),
    "bsd-advert": (
        "All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement:"),
    "epl-2": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "zlib-provided": (
        "This software is provided 'as-is', without any express or implied warranty."),
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:"),
    "bsl-1-grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so, all subject to the following:"),
    "bsl-1-notice": (
        "Distributed under the Boost Software License, Version 1.0."),
    "cc0-waiver": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide."),
    "cc-by-sa-4-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4-long": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "wtfpl": "This program is free software. It comes without any warranty, to the extent permitted by applicable law.",
    "mpl-2": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "cc-by-4-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Names that short references use, by SPDX identifier.
NAMES = {
    "MIT": "the MIT License", "ISC": "the ISC License", "Apache-2.0": "the Apache License 2.0",
    "BSD-2-Clause": "the BSD 2-Clause License", "BSD-3-Clause": "the BSD 3-Clause License",
    "GPL-2.0-only": "the GNU General Public License, version 2", "GPL-3.0-only": "the GNU General Public License, version 3",
    "LGPL-2.1-only": "the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0-only": "the GNU Lesser General Public License, version 3",
    "AGPL-3.0-only": "the GNU Affero General Public License, version 3",
    "MPL-2.0": "the Mozilla Public License 2.0", "EPL-2.0": "the Eclipse Public License 2.0", "Zlib": "the zlib License",
    "BSL-1.0": "the Boost Software License 1.0", "CC0-1.0": "CC0 1.0", "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0", "CC-BY-NC-4.0": "CC BY-NC 4.0", "CC-BY-ND-4.0": "CC BY-ND 4.0",
    "Unlicense": "the Unlicense",
}

#: Sentences that refer to a licence by its name or identifier.
REFERENCES = ("Licensed under {name}.", "Released under {name}.", "Distributed under {name}, a software licence.",
              "This work is licensed under {name}.", "This project is licensed under {name}.",
              "SPDX-License-Identifier: {id}")

#: Ordered rules, (rule, licence, sequence of sentence identifiers).
TEXT_RULES = (
    ("x11-text", "X11", ("mit-grant", "mit-notice", "as-is-warranty", "mit-liable", "x11-name")),
    ("mit-full-text", "MIT", ("mit-grant", "mit-notice", "as-is-warranty", "mit-liable")),
    ("mit-text", "MIT", ("mit-grant", "mit-notice", "as-is-warranty")),
    ("mit-title", "MIT", ("mit-title",)),
    ("isc-full-text", "ISC", ("isc-grant", "isc-warranty")),
    ("isc-text", "ISC", ("isc-grant",)),
    ("0bsd-text", "0BSD", ("0bsd-grant", "isc-warranty")),
    ("apache-2-header", "Apache-2.0", ("apache-2-notice", "apache-2-obtain", "apache-2-basis")),
    ("apache-2-notice", "Apache-2.0", ("apache-2-notice",)),
    ("apache-2-reference", "Apache-2.0", ("apache-2",)),
    ("gpl-3-header", "GPL-3.0-or-later", ("gpl-later", "gpl-no-warranty")),
    ("gpl-2-header", "GPL-2.0-or-later", ("gpl-2-later", "gpl-no-warranty")),
    ("lgpl-2-header", "LGPL-2.1-or-later", ("lgpl-2-later", "lgpl-no-warranty")),
    ("lgpl-3-header", "LGPL-3.0-or-later", ("lgpl-3-later", "gpl-no-warranty")),
    ("agpl-3-header", "AGPL-3.0-or-later", ("agpl-3-later", "gpl-no-warranty")),
    ("gpl-2-only-header", "GPL-2.0-only", ("gpl-2-exactly", "gpl-no-warranty")),
    ("gpl-3-only-header", "GPL-3.0-only", ("gpl-3-exactly", "gpl-no-warranty")),
    ("bsd-4-text", "BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse")),
    ("bsd-3-full-text", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-provided")),
    ("bsd-3-text", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("bsd-2-full-text", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-provided")),
    ("bsd-2-text", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("mpl-2-notice", "MPL-2.0", ("mpl-2",)),
    ("epl-2-notice", "EPL-2.0", ("epl-2",)),
    ("zlib-text", "Zlib", ("zlib-provided", "zlib-grant")),
    ("bsl-1-text", "BSL-1.0", ("bsl-1-grant",)),
    ("bsl-1-notice", "BSL-1.0", ("bsl-1-notice",)),
    ("cc0-waiver", "CC0-1.0", ("cc0-waiver",)),
    ("cc-by-4-long", "CC-BY-4.0", ("cc-by-4-long",)),
    ("cc-by-sa-4-long", "CC-BY-SA-4.0", ("cc-by-sa-4-long",)),
    ("cc-by-nc-4-long", "CC-BY-NC-4.0", ("cc-by-nc-4-long",)),
    ("cc-by-nd-4-long", "CC-BY-ND-4.0", ("cc-by-nd-4-long",)),
    ("wtfpl-notice", "WTFPL", ("wtfpl",)),
    ("unlicense-text", "Unlicense", ("unlicense",)),
)

#: All sentences and rules: whole texts first, then each reference to a name.
SENTENCES = TEXTS | {f"{spdx.lower()}-ref-{k}": form.format(name=name, id=spdx)
                     for spdx, name in NAMES.items() for k, form in enumerate(REFERENCES, 1)}
RULES = TEXT_RULES + tuple((f"{spdx.lower()}-reference-{k}", spdx, (f"{spdx.lower()}-ref-{k}",))
                           for spdx in NAMES for k in range(1, len(REFERENCES) + 1))


def normal(sentence: str) -> str:
    """Lower-case words of a known sentence with holders' names as one word, as ``_pieces`` makes them of a text."""
    words = re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()
    for pattern, to in slot_patterns():
        words = re.sub(pattern, to.replace("$", "\\"), words)
    return words


def slot_patterns() -> list[tuple[str, str]]:
    """(pattern, replacement) of each slot, over words that blanks or ``|`` (between pieces) part."""
    part = lambda words: words.replace(" ", "[ |]")
    return [(rf"\b({part(before)}[ |])(?:[a-z0-9]+[ |]){{1,{SLOT_WORDS}}}?({part(after)})\b", f"$1{HOLDER} $2")
            for before, after in SLOTS]


def _pieces(text: Column) -> Column:
    """Pieces of a lower-case text."""
    cut = F.split(F.regexp_replace(text, r"([.!?:])[ \t\r\n]+", "$1\n"), "\n")
    words = F.transform(cut, lambda p: F.trim(F.regexp_replace(p, r"[^a-z0-9]+", " ")))
    line = F.array_join(F.filter(words, lambda p: p != ""), "|")
    for pattern, to in slot_patterns():
        line = F.regexp_replace(line, pattern, to)
    return F.split(line, r"\|")


def sentence_ids(pieces: Column, sentences: dict[str, str]) -> Column:
    """(place, end, id) of the known sentences in a text's pieces, none inside another; places count from 0."""
    names = {f"{normal(s)} ": i for i, s in sentences.items()}
    first = sorted({s.split()[0] for s in names})
    table = F.array(*(F.lit(s) for s in names))
    most = max(len(s.split()) for s in names)  # a piece has a word at least, so no sentence has more pieces
    ids = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))

    def state(left: Column, run: Column, end: Column, sentence: Column) -> Column:
        return F.struct(left.alias("left"), run.alias("run"), end.alias("end"), sentence.alias("sentence"))

    def grow(had: Column, piece: Column) -> Column:
        run = F.concat(had["run"], piece["word"], F.lit(" "))
        left, whole = F.filter(had["left"], lambda s: F.startswith(s, run)), run.isin(*names)
        longer = state(left, run, F.when(whole, piece["end"]).otherwise(had["end"]), F.when(whole, run).otherwise(had["sentence"]))
        return F.when(F.size(had["left"]) > 0, longer).otherwise(had)

    def longest(at: Column) -> Column:
        none = state(table, F.lit(""), F.lit(0), F.lit(None).cast("string"))
        words = F.transform(F.slice(pieces, at + 1, F.lit(most)),
                            lambda p, k: F.struct(p.alias("word"), (at + k + 1).alias("end")))
        return F.aggregate(words, none, grow, lambda had: F.struct(
            at.alias("place"), had["end"], F.element_at(ids, had["sentence"]).alias("id")))

    places = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda at: F.split_part(F.get(pieces, at), F.lit(" "), F.lit(1)).isin(*first))
    return F.filter(F.transform(places, longest), lambda s: s["id"].isNotNull())


def _outermost(found: Column, most: int) -> Column:
    """The sentences that no earlier one covers; at most ``most`` begin inside one sentence, so no more are looked at."""
    def free(one: Column, at: Column) -> Column:
        before = F.slice(found, F.greatest(at + 1 - most, F.lit(1)), F.least(at, F.lit(most)))
        return ~F.exists(before, lambda other: other["end"] >= one["end"])

    return F.filter(found, free)


def _matches(sequence: Column, rules: tuple[tuple[str, str, tuple[str, ...]], ...]) -> Column:
    """(rule, licence, n, before) of the rules that match in their order, each taking its sentences from the rest."""
    table = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(name).alias("licence"),
                               F.lit("".join(f"<{i}>" for i in ids)).alias("want"), F.lit("<>" * len(ids)).alias("taken"))
                      for r, name, ids in rules))
    kind = "array<struct<rule:string,licence:string,n:bigint,before:int>>"

    def apply(had: Column, rule: Column) -> Column:
        rest, want = had["rest"], rule["want"]
        n = (F.length(rest) - F.length(F.replace(rest, want, F.lit("")))) / F.length(want)
        before = F.size(F.split(F.split_part(rest, want, F.lit(1)), "<")) - 1
        hit = F.array(F.struct(rule["rule"].alias("rule"), rule["licence"].alias("licence"),
                               n.cast("long").alias("n"), before.alias("before"))).cast(kind)
        return F.when(F.contains(rest, want), F.struct(F.replace(rest, want, rule["taken"]).alias("rest"),
                                                       F.concat(had["hits"], hit).alias("hits"))).otherwise(had)

    return F.aggregate(table, F.struct(sequence.alias("rest"), F.array().cast(kind).alias("hits")), apply,
                       lambda had: had["hits"])


def scan(docs: DataFrame, text_col: str = "text", sentences: dict[str, str] = SENTENCES,
         rules: tuple[tuple[str, str, tuple[str, ...]], ...] = RULES, hints: tuple[str, ...] = HINTS) -> DataFrame:
    """``docs``' other columns with (rule, licence, n_matches, first_piece, sentences), a row for each rule that matches."""
    bare = [s for s in sentences.values() if not any(h in normal(s) for h in hints)]
    if bare:
        raise ValueError(f"sentences without a word of hints: {bare}")
    new = {"rule", "licence", "n_matches", "first_piece", "sentences"}
    others = [c for c in docs.columns if c != text_col and c not in new]
    pieces, found, hit = (free_name(docs, n) for n in ("pieces", "found", "hit"))
    most = max(len(normal(s).split()) for s in sentences.values())
    low = F.lower(F.col(text_col))
    # exploding an array of one keeps a value a column: what follows would compute it again at every place
    rows = docs.where(low.rlike("|".join(hints))).select(*others, F.explode(F.array(_pieces(low))).alias(pieces))
    rows = rows.select(*others, F.explode(F.array(sentence_ids(F.col(pieces), sentences))).alias(found))
    rows = rows.where(F.size(found) > 0).select(*others, F.explode(F.array(_outermost(F.col(found), most))).alias(found))
    sequence = F.array_join(F.transform(found, lambda s: F.concat(F.lit("<"), s["id"], F.lit(">"))), "")
    rows = rows.withColumn("sentences", sequence)
    rows = rows.withColumn(hit, F.explode(_matches(F.col("sentences"), rules)))
    at = F.get(found, F.col(hit)["before"])["place"]
    return rows.select(*others, F.col(hit)["rule"].alias("rule"), F.col(hit)["licence"].alias("licence"),
                       F.col(hit)["n"].alias("n_matches"), at.alias("first_piece"), "sentences")
