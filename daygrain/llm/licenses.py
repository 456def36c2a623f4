"""Licences in texts: sentences become identifiers, and ordered rules match sequences of identifiers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the sentences of well-known licence texts and notices, and the licence that each sequence stands for
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_GNU_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
)
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        _AS_IS,
    )),
    ("BSD-3-Clause", (_BSD_1, _BSD_2, _BSD_3)),
    ("BSD-2-Clause", (_BSD_1, _BSD_2)),
    ("ISC", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    )),
    ("Apache-2.0", (
        'Licensed under the Apache License, Version 2.0 (the "License");',
        "you may not use this file except in compliance with the License.",
    )),
    ("GPL-3.0-or-later", (
        "This program is free software:",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
        *_GNU_WARRANTY,
    )),
    ("GPL-2.0-or-later", (
        "This program is free software;",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation;",
        "either version 2 of the License, or (at your option) any later version.",
        *_GNU_WARRANTY,
    )),
    ("MPL-2.0", ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",)),
    ("Unlicense", ("This is free and unencumbered software released into the public domain.",)),
    ("Apache-2.0", ("Licensed under the Apache License, Version 2.0.",)),
    ("MIT", ("Released under the MIT License.",)),
    ("MIT", ("Licensed under the MIT License.",)),
    ("GPL-3.0-only", ("This work is licensed under the GNU General Public License, version 3.",)),
    ("CC-BY-NC-4.0", ("Licensed under CC BY-NC 4.0.",)),
    ("CC-BY-4.0", ("Licensed under CC BY 4.0.",)),
    ("CC-BY-4.0", ("This work is licensed under a Creative Commons Attribution 4.0 International License.",)),
    ("CC-BY-SA-4.0", ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",)),
    ("CC0-1.0", ("To the extent possible under law, the author has dedicated all copyright to this work to the public domain.",)),
)

BREAK = r"([.;:!?])[\x20\t]+"  # a sentence ends here


def normalised(sentence: str) -> str:
    """Lower-case ASCII letters and digits, one space for anything between."""
    lowered = "".join(c.lower() if c.isascii() else c for c in sentence)
    return re.sub(r"[^a-z0-9]+", " ", lowered).strip()


@dataclass(frozen=True)
class Rules:
    """Sentence identifiers from 1 on, and rules over them in order: longer sequences first, then as listed."""

    sentences: tuple[str, ...]
    rules: tuple[tuple[str, tuple[int, ...]], ...]


def compiled(rules=RULES) -> Rules:
    split = [
        (name, [normalised(s) for text in sentences for s in re.sub(BREAK, "\\1\n", text).split("\n")]) for name, sentences in rules
    ]
    known = tuple(dict.fromkeys(s for _, sentences in split for s in sentences))
    numbered = [(name, tuple(known.index(s) + 1 for s in sentences)) for name, sentences in split]
    return Rules(known, tuple(sorted(numbered, key=lambda r: -len(r[1]))))


def sentence_ids(text: Column, known: tuple[str, ...]) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    lines = F.split(F.regexp_replace(text, BREAK, "$1\n"), "\n")
    ids = F.create_map(*[F.lit(x) for i, s in enumerate(known) for x in (s, i + 1)])
    plain = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    return F.filter(F.transform(lines, lambda s: ids[plain(s)]), lambda i: i.isNotNull())


def recognised(ids: Column, rules: Rules) -> Column:
    """Licence names in the order of their place; each identifier serves the first rule that takes it."""
    # 1,2,3 is written <1><2><3>, and a rule puts its name in place of its identifiers
    out = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    for name, sequence in rules.rules:
        out = F.replace(out, F.lit("".join(f"<{i}>" for i in sequence)), F.lit(f"[{name}]"))
    return F.regexp_extract_all(out, F.lit(r"\[([^\]]+)\]"), F.lit(1))


def licenses(docs: DataFrame, rules=RULES) -> DataFrame:
    """Licences of each document (doc_id, text): doc_id, sentences (known identifiers in order) and licenses (names).

    A text is read twice: line by line, and with its line ends taken as spaces, for notices that are wrapped.  Each
    reading is cut into sentences, normalised, looked up, and matched by the ordered rules; the names of both come
    out once each, sorted.  Everything is row by row.  Defined results: a null or empty text has neither; repeated
    sentences are found again and named once; rows with a null or repeated doc_id stay rows; an empty table gives no
    rows; other columns are not read.
    """
    made = compiled(rules)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    read = rows.select(
        "doc_id", sentence_ids(F.col("text"), made.sentences).alias("sentences"),
        sentence_ids(F.regexp_replace("text", r"[\n\r]+", " "), made.sentences).alias("unwrapped"),
    )
    names = F.array_distinct(F.concat(recognised(F.col("sentences"), made), recognised(F.col("unwrapped"), made)))
    both = F.when(F.size("unwrapped") > F.size("sentences"), F.col("unwrapped")).otherwise(F.col("sentences"))
    return read.select("doc_id", both.alias("sentences"), F.array_sort(names).alias("licenses"))
