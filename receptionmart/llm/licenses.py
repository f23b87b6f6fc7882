"""Licence notices, recognised by sentences.

A text is cut into pieces at line ends and stops, each is normalised (lower case, runs of other signs become one space)
and looked up in a table of known licence sentences. A known sentence may also run over several pieces of a paragraph,
since notices are wrapped and hold stops ("v. 2.0", "free software: you can"); a blank line ends a paragraph, and so does
a line of signs only, as in comments. Of the known sentences that start at a piece the longest counts. The identifiers of
the known sentences, in the order of the text and without the unknown sentences between them, are matched against rules: a
rule is an ordered list of identifiers that must occur in a row. Where matches overlap the longer rule wins, then the
earlier match. Results number the pieces.

The tables are parameters of a fixed size, so every task has them and no text is shuffled.

Defined cases: null and empty texts have no sentences and no notices; repeated rows are judged one by one; a notice that
occurs several times is reported as often; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches, text_rows

# Sentences of public licence notices, normalised, with their identifiers.
SENTENCES = {
    "mit-ref": "released under the mit license",
    "mit-ref-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mit-cond": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind",
    "apache-ref": "licensed under the apache license version 2 0",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "gpl3-ref": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "mpl-ref": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
# Rules: (licence, sentence identifiers in a row).
RULES = (
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-ref-2",)),
    ("MIT", ("mit-grant", "mit-cond", "as-is")),
    ("MIT", ("mit-grant", "mit-cond")),
    ("Apache-2.0", ("apache-ref",)),
    ("Apache-2.0", ("apache-ref", "apache-use", "apache-copy", "apache-as-is")),
    ("GPL-3.0", ("gpl3-ref",)),
    ("GPL", ("gpl-free", "gpl-hope")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("MPL-2.0", ("mpl-ref",)),
    ("Unlicense", ("unlicense",)),
)
# Further wordings: sentences of the verbatim notices that say more than the table, or say it differently.
_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND '
WORDINGS = (
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit-cond", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software."),
    ("as-is", _AS_IS + "NONINFRINGEMENT."),
    ("as-is", _AS_IS + "NON-INFRINGEMENT."),
    ("apache-ref", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("apache-as-is", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("gpl-free", _GPL + ", either version 3 of the License, or (at your option) any later version."),
    ("gpl-free", _GPL + "; either version 2 of the License, or (at your option) any later version."),
    ("gpl-free", _GPL + ", version 3 of the License."),
    ("gpl-free", _GPL + "; version 2 of the License."),
    ("gpl-free", _GPL.replace(" as published", " version 3 as published") + "."),
    ("gpl-free", _GPL.replace(" as published", " version 2 as published") + "."),
)
# A sentence ends at a line end, or at a stop before white space.
SENTENCE_END = re.compile(r"[.;:!?]+[ \t\r]|\n")
BLANKS = " \t\x0b\x0c\r"
SCHEMA = "doc_id bigint, license string, n_sentences bigint, first_sentence bigint, last_sentence bigint, text_sentences bigint"
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
_OTHER = re.compile(r"[^A-Za-z0-9]+")


def normalised(sentence: str) -> str:
    """ASCII letters in lower case and digits; all other signs are spaces."""
    return _OTHER.sub(" ", sentence).strip().lower()


def by_first_word(sentences: Mapping[str, str], wordings: Sequence[tuple[str, str]]) -> dict[str, list[tuple[str, str]]]:
    """(normalised sentence, identifier) of both tables under the first word, longer sentences first."""
    known: dict[str, list[tuple[str, str]]] = {}
    for text, name in {normalised(text): name for name, text in (*wordings, *sentences.items())}.items():
        known.setdefault(text.split(" ")[0], []).append((text, name))
    return {word: sorted(own, key=lambda k: (-len(k[0]), k)) for word, own in known.items()}


def _last_piece(sentence: str, pieces: Sequence[tuple[str, int]], at: int) -> int | None:
    """The piece that ends ``sentence`` if it starts at piece ``at`` and stays in the paragraph."""
    done, paragraph = 0, pieces[at][1]
    for i in range(at, len(pieces)):
        part = pieces[i][0]
        if not part or pieces[i][1] != paragraph or not sentence.startswith(part, done):
            return None
        done += len(part)
        if done == len(sentence):
            return i
        if sentence[done] != " ":
            return None
        done += 1
    return None


def known_sentences(text: str, known: Mapping[str, Sequence[tuple[str, str]]]) -> tuple[list[tuple[int, int, str]], int]:
    """(first piece, last piece, identifier) of the known sentences, and the number of pieces that are not blank."""
    pieces, paragraph, start = [], 0, 0
    for stop in (*SENTENCE_END.finditer(text), None):
        piece = text[start : stop.start() if stop else len(text)]
        if piece.strip(BLANKS):
            pieces.append((normalised(piece), paragraph))
        elif start == 0 or text[start - 1] == "\n":
            paragraph += 1
        start = stop.end() if stop else start
    found, i = [], 0
    while i < len(pieces):
        ends = ((_last_piece(s, pieces, i), name) for s, name in known.get(pieces[i][0].split(" ")[0], ()))
        last, name = next((e for e in ends if e[0] is not None), (None, ""))
        if last is None:
            i += 1
            continue
        found.append((i, last, name))
        i = last + 1
    return found, len(pieces)


def matches(found: Sequence[tuple[int, int, str]], rules: Sequence[tuple[str, tuple[str, ...]]]) -> list[tuple[str, int, int, int]]:
    """(licence, sentences, first, last): longer rules first, no sentence in two matches."""
    names = [s for *_, s in found]
    free, out = [True] * len(found), []
    for licence, ids in sorted(rules, key=lambda r: (-len(r[1]), r)):
        for at in range(len(names) - len(ids) + 1):
            if tuple(names[at : at + len(ids)]) == ids and all(free[at : at + len(ids)]):
                free[at : at + len(ids)] = [False] * len(ids)
                out.append((licence, len(ids), found[at][0], found[at + len(ids) - 1][1]))
    return sorted(out, key=lambda m: m[2])


def find_licenses(
    df: DataFrame,
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, tuple[str, ...]]] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    wordings: Sequence[tuple[str, str]] = WORDINGS,
) -> DataFrame:
    """One row per notice. Pieces are numbered from 0, blank ones left out."""
    known = by_first_word(sentences, wordings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                found, n = known_sentences(text, known)
                if found:
                    rows += [(doc_id, *m, n) for m in matches(found, rules)]
            if rows:
                kinds = [pa.int64(), pa.string()] + [pa.int64()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], NAMES)

    return text_rows(df, id_col, text_col).selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, SCHEMA)
