"""License scans by conditional compression.

Texts are searched around licence keywords. The words of each stretch of text around them are cut into overlapping blocks, such that every
possible match of a template lies whole in one: small blocks for notices, large ones for bodies. A block is compressed alone
and with each template as a raw zstandard dictionary; the template saves the bytes by which the second is smaller, and the
templates that save at least LEAST_SAVED of their own size are ranked by the bytes they save. In that order, with no fixed
number of them, the wording decides: the template's words are aligned with the block's, and the words that are missing, other or
put in between are counted and listed. A match has at most 15 % of either, none of them a deciding word (a licence's name, a
version, a clause, a negation), and no negation stands just before it. Of overlapping matches the one whose text its template
saves more bytes of wins, so a full text isn't reported as its title line too.

A candidate is a stretch of text around keywords that no template can bridge. Null or empty text: no candidates. A row a
document, repeated rows and null doc_ids included; an empty table gives no rows; other columns are ignored, whatever their names. Of matches that
save the same, the one of fewer differences, then the earlier, then the first by name counts. Documents don't meet, so there is
nothing to shuffle; a text costs time in proportion to its keywords' stretches.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import id_text

# The wording of public licences and their usual notices.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("GPL-2.0", "GNU GPL v2"), ("GPL-3.0", "GNU GPL v3"), ("LGPL-3.0", "GNU LGPL v3"), ("AGPL-3.0", "GNU AGPL v3"), ("CC-BY-4.0", "CC-BY-4.0"), ("CC-BY-NC-4.0", "CC-BY-NC-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"),
    *[(name, f"SPDX-License-Identifier: {name}") for name in (
        "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense",
    )],
]
#: Words that a match must have just as its template has them: names and negations; versions and clauses are known by form.
NAMES = frozenset(
    "affero agpl apache attribution bsd by cc cc0 commons creative gnu gpl isc lesser lgpl mit mozilla mpl noderivatives noncommercial"
    " sharealike spdx-license-identifier unlicense".split()
)
NEGATIONS = frozenset("not never no cannot without isn't aren't non neither nor unlicensed except".split())
VERSION = re.compile(r"v?\d{1,2}(\.\d+)*|\d-clause|.*-\d.*")

KEYWORD = re.compile(r"licen[sc]|copyright|permission|redistribut|warrant|public[\W_]+domain|creative[\W_]+commons|\bcc[\W_]+by|spdx|\b[la]?gpl\b", re.IGNORECASE)
#: One of these is in every text that has a keyword.
KEYS = ("licens", "licenc", "copyright", "permission", "redistribut", "warrant", "domain", "commons", "cc", "spdx", "gpl")
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
#: The wording that confirms a template: the share of its words that is there, and of words put in between.
LEAST_COVERED, MOST_EXTRA = 0.85, 0.15
#: The share of its own compressed size that a template must save of a block to be looked at, and the level of compression.
LEAST_SAVED, LEVEL = 0.2, 4
#: Letters before every block: of a few dozen bytes the compressor codes the letters or doesn't, and sizes can't be compared.
PADDING = "quick wizards vex jumbo foxglove 0123456789 by sphinx of black quartz, judging my vow; hazy jackdaws flex and pack big boxes of five dozen quilts\n" * 2
#: Bytes that a first reference into a dictionary costs by itself: what a template of one word can't save.
REFERENCE_BYTES = 3
#: Templates of up to so many words are notices, which are looked for in small blocks.
NOTICE_WORDS = 20

SCHEMA = "doc_id long, n_candidates long, licenses string, n_matches long, n_differences long, matches array<struct<license: string, start: long, stop: long, saved: double, missing: array<string>, added: array<string>>>"


@functools.cache
def compressors() -> tuple:
    """A plain compressor, and for each template its name, compressor, words and own compressed size."""
    settings = {"level": LEVEL, "write_content_size": False, "write_checksum": False}
    plain = zstandard.ZstdCompressor(**settings)
    own, nothing = [], len(plain.compress(b""))
    for name, text in TEMPLATES:
        raw = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        words = [w.lower() for w in WORD.findall(text)]
        own.append((name, zstandard.ZstdCompressor(dict_data=raw, write_dict_id=False, **settings), words, len(plain.compress(text.lower().encode())) - nothing))
    return plain, own


@functools.cache
def patterns() -> tuple:
    """A number for each template word; for each template its word flags by number, its length, and the places of its keywords."""
    _, own = compressors()
    number = {w: i for i, w in enumerate(sorted({w for _, _, words, _ in own for w in words}))}
    out = []
    for (_, text), (_, _, words, _) in zip(TEMPLATES, own, strict=True):
        known = np.zeros(len(number) + 1, np.int64)  # the last one: words of no template
        known[[number[w] for w in words]] = 1
        starts = [m.start() for m in WORD.finditer(text)]
        out.append((known, len(words), keyword_places(text, starts)))
    return number, out


def keyword_places(text: str, starts: Sequence[int]) -> np.ndarray:
    """The words (by the places where they start, ascending) that keywords begin in."""
    return np.array(sorted({max(0, bisect.bisect_right(starts, m.start()) - 1) for m in KEYWORD.finditer(text)}), np.int64)


def slack(n: int) -> int:
    """Words that a confirmed match of a template of n words may be longer or shorter."""
    return int(max(MOST_EXTRA, 1 - LEAST_COVERED) * n) + 1


def alignment(words: list[str], template: list[str]) -> tuple[int, int, int, list[str], list[str]]:
    """Covered template words, the first and last matched word of the block, and the words missing and added between."""
    found = [m for m in difflib.SequenceMatcher(None, words, template, autojunk=False).get_matching_blocks() if m.size]
    if not found:
        return 0, 0, 0, template, []
    # the densest stretch: a word matched far off belongs to other text
    while len(found) > 1 and found[1].a - (found[0].a + found[0].size) > 3 * found[0].size + 3:
        found = found[1:]
    while len(found) > 1 and found[-1].a - (found[-2].a + found[-2].size) > 3 * found[-1].size + 3:
        found = found[:-1]
    first, stop = found[0].a, found[-1].a + found[-1].size
    ours = {m.a + i for m in found for i in range(m.size)}
    theirs = {m.b + i for m in found for i in range(m.size)}
    return len(theirs), first, stop, [w for i, w in enumerate(template) if i not in theirs], [words[i] for i in range(first, stop) if i not in ours]


def saved_bytes(text: str, templates: Sequence[int]) -> list[int]:
    """How many bytes smaller a text is compressed with each of the templates as dictionary than alone."""
    plain, own = compressors()
    raw = (PADDING + text.lower()).encode("utf-8", "surrogatepass")
    alone = len(plain.compress(raw))
    return [alone - len(own[t][1].compress(raw)) for t in templates]


def ranked(text: str, templates: Sequence[int]) -> list[int]:
    """The templates that save at least LEAST_SAVED of their size of a block, less what a reference costs, those that save most bytes first."""
    own = compressors()[1]
    saved = [(s, t) for s, t in zip(saved_bytes(text, templates), templates, strict=True) if s >= LEAST_SAVED * own[t][3] - REFERENCE_BYTES]
    return [t for _, t in sorted(saved, key=lambda x: (-x[0], x[1]))]


def deciding(word: str) -> bool:
    return word in NAMES or word in NEGATIONS or VERSION.fullmatch(word) is not None or any(p in NAMES for p in word.split("-") if p != "by")


def confirmed(words: Sequence[str], before: Sequence[str], template: list[str], missing: list[str], added: list[str]) -> bool:
    """Whether the wording makes the match: few differences, no deciding word among them, no negation just before."""
    n = len(template)
    if len(missing) > (1 - LEAST_COVERED) * n or len(added) > MOST_EXTRA * n:
        return False
    other = [w for w in added if w != "by"]
    return not any(map(deciding, missing)) and not any(map(deciding, other)) and not any(w in NEGATIONS or w.endswith("n't") for w in before)


@functools.cache
def groups() -> list[tuple[list[int], int]]:
    """Notices and bodies, each with the words that a match of one takes at most."""
    sizes = [(t, len(words)) for t, (_, _, words, _) in enumerate(compressors()[1])]
    parts = [[x for x in sizes if x[1] <= NOTICE_WORDS], [x for x in sizes if x[1] > NOTICE_WORDS]]
    return [([t for t, _ in part], max(n + slack(n) for _, n in part)) for part in parts]


def blocks_of(keys: np.ndarray, reach: int, n_words: int) -> list[tuple[int, int]]:
    """Blocks of 2 * reach words, each half over the next, of those that hold a keyword."""
    halves = np.unique(np.concatenate([keys // reach, keys // reach - 1]))
    return [(max(0, int(h) * reach), min(n_words, (int(h) + 2) * reach)) for h in halves if (int(h) + 2) * reach > 0]


def scan_text(text: str | None) -> tuple[int, list[dict]]:
    """Candidate stretches and confirmed matches (start, stop in characters) of a text."""
    text = text or ""
    lower = text.lower()
    if not any(k in lower for k in KEYS) or not KEYWORD.search(text):
        return 0, []
    number, templates = patterns()
    starts, stops, ids = array("q"), array("q"), array("q")
    for m in WORD.finditer(text):
        starts.append(m.start())
        stops.append(m.end())
        ids.append(number.get(m[0].lower(), len(number)))
    keys = keyword_places(text, starts)
    if not len(starts):
        return 0, []
    word = np.frombuffer(ids, np.int64)
    n_candidates = 1 + int((np.diff(keys) > 2 * max(reach for _, reach in groups())).sum())
    found: dict[tuple[int, int, int], dict] = {}
    for members, reach in groups():
        for low, high in blocks_of(keys, reach, len(word)):
            for t in ranked(text[starts[low] : stops[high - 1]], members):
                for m in matches_in(text, starts, stops, word, keys, low, high, t):
                    found[t, m["start"], m["stop"]] = m
    kept: list[dict] = []
    for m in sorted(found.values(), key=lambda m: (-m.pop("bytes"), len(m["missing"]) + len(m["added"]), m["start"], m["license"])):
        at = bisect.bisect_left(kept, m["stop"], key=lambda k: k["start"])
        if not at or kept[at - 1]["stop"] <= m["start"]:
            kept.insert(at, m)
    return n_candidates, kept


def matches_in(text: str, starts: Sequence[int], stops: Sequence[int], word: np.ndarray, keys: np.ndarray, low: int, high: int, t: int) -> list[dict]:
    """The confirmed matches of a template in a block: where it may lie with a keyword of its own on one of the text's."""
    (known, n, places), (name, _, template, own) = patterns()[1][t], compressors()[1][t]
    spare, need = slack(n), LEAST_COVERED * n

    def aligned(a: int, b: int) -> tuple[int, int, int, list[str], list[str]]:
        covered, first, stop, missing, added = alignment([text[x:y].lower() for x, y in zip(starts[a:b], stops[a:b], strict=True)], template)
        return covered, a + first, a + stop, missing, added

    here = keys[np.searchsorted(keys, low) : np.searchsorted(keys, high)]
    begins = np.unique((here[:, None] - places[None, :]).reshape(-1))
    lows, highs = np.clip(begins - spare, low, high), np.clip(begins + n + spare, low, high)
    before = np.concatenate([[0], np.cumsum(known[word[low:high]])])
    enough = before[highs - low] - before[lows - low] >= need  # a covered word is a word of the template
    out: list[dict] = []
    settled = -(10**9)  # no window that begins before this can hold a match that hasn't been found
    for a, b, begin in zip(lows[enough].tolist(), highs[enough].tolist(), begins[enough].tolist(), strict=True):
        if begin < settled:
            continue
        covered, first, stop, missing, added = aligned(a, b)
        if covered < need:
            settled = begin + max(1, int(np.ceil(need - covered)))  # each word further brings one new word at most
            continue
        # the window may end inside the match: look once more with words to spare on both sides of it
        wider = aligned(max(0, first - spare), min(len(word), stop + spare))
        if wider[0] - len(wider[4]) > covered - len(added):
            covered, first, stop, missing, added = wider
        words = [text[x:y].lower() for x, y in zip(starts[first:stop], stops[first:stop], strict=True)]
        leading = text[starts[max(0, first - 3)] : starts[first]].lower().replace("’", "'").split() if first else []
        leading = [w.strip(".,;:()\"") for w in leading[-3:]]
        if confirmed(words, leading, template, missing, added):
            settled = begin + spare
            matched = text[starts[first] : stops[stop - 1]]
            saved = saved_bytes(matched, [t])[0]
            out.append({"license": name, "start": starts[first], "stop": stops[stop - 1], "saved": saved / own, "missing": missing, "added": added, "bytes": saved})
    return out


def scan(docs: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [scan_text(t) for t in pdf["text"]]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "n_candidates": [n for n, _ in found],
                "licenses": [",".join(sorted({m["license"] for m in ms})) for _, ms in found], "n_matches": [len(ms) for _, ms in found],
                "n_differences": [sum(len(m["missing"]) + len(m["added"]) for m in ms) for _, ms in found], "matches": [ms for _, ms in found],
            })

    return id_text(docs).mapInPandas(rows, SCHEMA)
