"""License scans by conditional compression.

Lines (long ones: sentences) that hold a licensing word, with at most two others between them, form candidate
blocks. A block is compressed alone and with each template as a raw Zstandard dictionary; the relative
reduction in size ranks the templates. All templates of which a block has enough words are confirmed by their
exact wording: the words of the template that a stretch of the block lacks and the words it has between them. A
stretch is ``exact`` when there are none, ``modified`` when it has at least ``COVER`` of the template's words,
either with at most as many others between them as the template has words or in runs of ``RUN`` words on average.

Every stretch of a block that does not overlap a better one is a span of its own, the most shared words less
differences first, then the larger reduction. Lines with a licensing word outside of such spans are
``mention`` without a license.

Null and empty texts have no blocks. Whole texts are searched, however long. Starts and ends are code points,
end exclusive. Repeated rows get equal results. A column that bears the name of the result is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from clickloom.llm.texts import add_columns, strings

# Wordings by which licenses are granted, as their publishers give them, without names and years.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "proprietary": ("All rights reserved", "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher."),
}
CUES = ("licen", "permission", "redistribut", "copyright", "public domain", "spdx", "rights reserved")
COVER = 0.8
RUN = 3
# Among so many the reduction ranks the license of an unchanged wording; wordings are confirmed for all templates.
CONFIRMED = 3
GAP = 2
LONG_LINE = 600

BLOCKS = (
    "array<struct<license: string, verdict: string, start: bigint, end: bigint, gain: double, missing: array<string>, extra: array<string>>>"
)
_WORD = re.compile(r"[^\W_]+(?:[.\-/'][^\W_]+)*")
_UNIT = re.compile(r"[^\n]+")
_CLOSING = re.compile(r"[^\w\s]*")


def units(text: str) -> list[tuple[int, int]]:
    """Lines, and the sentences of long lines."""
    out = []
    for m in _UNIT.finditer(text):
        if m.end() - m.start() <= LONG_LINE:
            out.append(m.span())
            continue
        start = m.start()
        for end in [e.end() for e in re.finditer(r"[.!?](?=\s)", text[m.start() : m.end()])] + [m.end() - m.start()]:
            end += m.start()
            if end > start:
                out.append((start, end))
            start = end
    return out


def blocks(text: str) -> list[tuple[int, int]]:
    """Candidate blocks: units with a licensing word, joined over at most ``GAP`` units without one."""
    if not any(c in text.lower() for c in CUES):
        return []
    out: list[list[int]] = []
    last = -GAP - 2
    for i, (a, b) in enumerate(units(text)):
        low = text[a:b].lower()
        if any(c in low for c in CUES):
            if i - last <= GAP + 1:
                out[-1][1] = b
            else:
                out.append([a, b])
            last = i
    return [(a, b) for a, b in out]


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Scanner:
    """Templates with their compressors, made once per worker."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.alone = zstandard.ZstdCompressor(level=19, write_content_size=False)
        self.templates = []
        for name, wordings in templates.items():
            for wording in wordings:
                own = words(wording)
                raw = zstandard.ZstdCompressionDict((" ".join(own) + " ").encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.templates.append((name, own, zstandard.ZstdCompressor(level=19, dict_data=raw, write_content_size=False)))

    def rank(self, block: list[str]) -> list[tuple[float, int]]:
        """(relative reduction, template) from the largest; equal ones in the order of the templates."""
        data = " ".join(block).encode()
        size = len(self.alone.compress(data))
        gains = [(1 - len(c.compress(data)) / size, -i) for i, (_, _, c) in enumerate(self.templates)]
        return [(g, -i) for g, i in sorted(gains, reverse=True)]

    def align(self, template: int, block: list[str], lo: int, hi: int) -> tuple[int, int, int, list[str], list[str]] | None:
        """(first, end, shared words, missing, extra) of the template's wording in ``block[lo:hi]``, if it is there."""
        own = self.templates[template][1]
        same = [m for m in SequenceMatcher(None, own, block[lo:hi], autojunk=False).get_matching_blocks() if m.size]
        shared = sum(m.size for m in same)
        if shared < COVER * len(own):
            return None
        first, end = lo + same[0].b, lo + same[-1].b + same[-1].size
        if end - first - shared > len(own) and shared < RUN * len(same):
            return None
        held = {k for m in same for k in range(m.a, m.a + m.size)}
        matched = {lo + k for m in same for k in range(m.b, m.b + m.size)}
        return first, end, shared, [w for k, w in enumerate(own) if k not in held], [block[k] for k in range(first, end) if k not in matched]

    def candidates(self, block: list[str], lo: int, hi: int) -> list[tuple]:
        """(template, *alignment) of all templates in windows over ``block[lo:hi]`` and in the whole of it."""
        have, out = Counter(block[lo:hi]), {}
        for i, (_, own, _) in enumerate(self.templates):
            bag, need = Counter(own), math.ceil(COVER * len(own) - 1e-9)
            if sum(min(n, have[w]) for w, n in bag.items()) < need:
                continue
            # Every stretch of at most twice the template's words lies in one of the windows.
            step = max(1, len(own) // 8)
            windows = [(at, min(hi, at + 2 * len(own) + step)) for at in range(lo, max(lo + 1, hi - need + 1), step)]
            hits = [0]
            for k in range(lo, hi):
                hits.append(hits[-1] + (block[k] in bag))
            for a, b in dict.fromkeys([(lo, hi), *windows]):
                if hits[b - lo] - hits[a - lo] < need:
                    continue
                near = Counter(w for w in block[a:b] if w in bag)
                if sum(min(n, near[w]) for w, n in bag.items()) >= need:
                    found = self.align(i, block, a, b)
                    if found:
                        out[(i, *found[:3])] = (i, *found)
        return list(out.values())

    def wordings(self, block: list[str], gains: dict[int, float]) -> list[tuple]:
        """The confirmed alignments that do not overlap better ones, by their place in the block."""
        out, open_ = [], [(0, len(block))]
        while open_:
            lo, hi = open_.pop()
            chosen: list[tuple] = []
            for c in sorted(self.candidates(block, lo, hi), key=lambda c: (-(c[3] - len(c[4]) - len(c[5])), -gains[c[0]], c)):
                if all(c[2] <= first or c[1] >= end for _, first, end, *_ in chosen):
                    chosen.append(c)
            if chosen:
                # What lies between them may hold wordings whose best alignment overlapped one of them.
                chosen.sort(key=lambda c: c[1])
                edges = [lo, *(x for c in chosen for x in c[1:3]), hi]
                open_ += [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
                out += chosen
        return sorted(out, key=lambda c: c[1])

    def judge(self, text: str) -> list[dict]:
        out = []
        for a, b in blocks(text):
            places = list(_WORD.finditer(text, a, b))
            block = [m[0].lower() for m in places]
            ranked = self.rank(block)
            gains = {i: gain for gain, i in ranked}
            at = a
            for i, first, end, _, missing, extra in self.wordings(block, gains):
                start, stop = places[first].start(), _CLOSING.match(text, places[end - 1].end(), b).end()
                out += self.mentions(text, at, start)
                verdict = "modified" if missing or extra else "exact"
                out.append({"license": self.templates[i][0], "verdict": verdict, "start": start, "end": stop, "gain": gains[i], "missing": missing, "extra": extra})
                at = stop
            if at == a:
                out.append({"license": None, "verdict": "mention", "start": a, "end": b, "gain": ranked[0][0] if ranked else 0.0, "missing": [], "extra": []})
            else:
                out += self.mentions(text, at, b)
        return out

    def mentions(self, text: str, start: int, end: int) -> list[dict]:
        """The blocks of a stretch between confirmed wordings."""
        out = []
        for a, b in blocks(text[start:end]):
            ranked = self.rank(words(text[start + a : start + b]))
            out.append({"license": None, "verdict": "mention", "start": start + a, "end": start + b, "gain": ranked[0][0] if ranked else 0.0, "missing": [], "extra": []})
        return out


_SCANNERS: dict[int, Scanner] = {}


def scan_licenses(df: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, text: str = "text", licenses: str = "licenses") -> DataFrame:
    """``df`` with the candidate blocks of each whole text and what they license."""
    key = hash(tuple(templates.items()))

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if key not in _SCANNERS:
            _SCANNERS[key] = Scanner(templates)
        scanner = _SCANNERS[key]
        listed = pa.list_(pa.string())
        struct = pa.struct([("license", pa.string()), ("verdict", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("gain", pa.float64()), ("missing", listed), ("extra", listed)])
        return {licenses: pa.array([scanner.judge(t) for t in strings(batch.column(text))], pa.list_(struct))}

    return add_columns(df, make, f"{licenses} {BLOCKS}")
