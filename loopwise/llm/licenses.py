"""License scans by patience alignment with known notices and grants."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import split_table

# Wording of public licenses and of their usual notices.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "Apache-2.0": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "
        '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.'
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies."
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0": (
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies "
        "of this license document, but changing it is not allowed. Preamble The licenses for most software are designed to take away your freedom."
    ),
    "GPL-3.0": (
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies "
        "of this license document, but changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works."
    ),
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "rights-reserved": "All rights reserved. No part of this publication may be reproduced without prior written permission.",
}
# Words of a template that tell it from its kin, and must be among those that a match pairs.
TELLING = {
    "Apache-2.0-notice": "apache 2.0",
    "Apache-2.0-header": "apache 2.0",
    "Apache-2.0": "apache 2.0",
    "MIT-notice": "mit",
    "BSD-3-Clause": "neither endorse promote",
    "BSL-1.0-notice": "boost 1.0",
    "GPL-3.0-notice": "general 3",
    "GPL-3.0-header": "general 3",
    "GPL-2.0-header": "general 2",
    "LGPL-2.1-header": "lesser 2.1",
    "LGPL-3.0-header": "lesser 3",
    "AGPL-3.0-header": "affero 3",
    "GPL-2.0": "general 2 1991",
    "GPL-3.0": "general 3 2007",
    "EPL-2.0": "eclipse 2.0",
    "MPL-2.0": "mozilla",
    "CC-BY-4.0-notice": "by 4.0",
    "CC-BY-SA-4.0-notice": "by-sa 4.0",
    "CC-BY-NC-4.0-notice": "by-nc 4.0",
    "CC-BY-ND-4.0-notice": "by-nd 4.0",
    "CC-BY-NC-SA-4.0-notice": "by-nc-sa 4.0",
    "CC-BY-NC-ND-4.0-notice": "by-nc-nd 4.0",
    "CC-BY-4.0": "attribution 4.0",
    "CC-BY-SA-4.0": "attribution-sharealike 4.0",
    "CC-BY-NC-4.0": "attribution-noncommercial 4.0",
    "CC-BY-ND-4.0": "attribution-noderivatives 4.0",
    "CC-BY-NC-SA-4.0": "attribution-noncommercial-sharealike 4.0",
    "CC-BY-NC-ND-4.0": "attribution-noncommercial-noderivatives 4.0",
}
# Words that make the name another license's: a match of these templates may not have one in its midst.
FOREIGN = {name: "lesser affero" for name in ("GPL-2.0", "GPL-2.0-header", "GPL-3.0", "GPL-3.0-header", "GPL-3.0-notice")}
# Words too common to start a search with, if others do.
COMMON = frozenset("a an and any are as at be by for from if in is it no not of on or that the this to was with without you".split())
_WORD = re.compile(rb"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def words_of(text: str) -> list[tuple[bytes, int, int]]:
    """(lower-cased word, start, end) with places in the text's UTF-8 bytes."""
    return [(m[0], *m.span()) for m in _WORD.finditer(text.encode("utf-8", "surrogatepass").lower())]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs of a patience alignment of two sequences.

    Equal ends are paired; words that occur once in each of what is left are
    anchors, of which the longest increasing subsequence is kept; and the gaps
    between anchors are aligned in the same way. A gap without anchors pairs
    nothing but its equal ends.
    """
    out, stack = [], [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        places: tuple[dict, dict] = (defaultdict(list), defaultdict(list))
        for p, seq, lo, hi in ((places[0], a, a0, a1), (places[1], b, b0, b1)):
            for k in range(lo, hi):
                p[seq[k]].append(k)
        anchors = sorted((i[0], j[0]) for w, i in places[0].items() if len(i) == 1 and len(j := places[1].get(w, ())) == 1)
        if not anchors:
            continue
        # patience: each anchor goes on the leftmost pile whose top is larger, and remembers the top of the pile before
        tops: list[int] = []
        at: list[int] = []
        back = [-1] * len(anchors)
        for k, (_, j) in enumerate(anchors):
            pile = bisect_left(tops, j)
            back[k] = at[pile - 1] if pile else -1
            if pile == len(tops):
                tops.append(j)
                at.append(k)
            else:
                tops[pile], at[pile] = j, k
        chain, k = [], at[-1]
        while k >= 0:
            chain.append(anchors[k])
            k = back[k]
        chain.reverse()
        i0, j0 = a0, b0
        for i, j in [*chain, (a1, b1)]:
            if i > i0 and j > j0:
                stack.append((i0, i, j0, j))
            if i < a1:
                out.append((i, j))
            i0, j0 = i + 1, j + 1
    return sorted(out)


@lru_cache(maxsize=4)
def _prepared(templates: tuple[tuple[str, str], ...], least: float):
    """Templates as words, and for each cue word the (template, place) pairs it may stand for.

    A match that covers ``least`` of a template misses fewer words than the
    cues of that template have places, so it holds one of them at least.
    """
    words, cues = {}, defaultdict(list)
    for name, text in templates:
        own = [w for w, _, _ in words_of(text)]
        missed = int(len(own) * (1 - least) + 1e-9)
        words[name] = own, frozenset(own), len(set(own)) - missed  # a match lacks at most so many of the different words
        taken = 0
        for w in sorted(set(own), key=lambda w: (w.decode() in COMMON, own.count(w), -len(w), w)):
            if taken > missed:
                break
            for k, x in enumerate(own):
                if x == w:
                    cues[w].append((name, k))
                    taken += 1
    return words, dict(cues)


def _windows(i: int, k: int, size: int, n: int) -> list[tuple[int, int]]:
    """Stretches of a text of n words to align, for the template's word k at the text's word i.

    The narrow one allows for a quarter of the template's ``size`` on both
    sides; the wide one for as many words again as the template has, which is
    all that a match may hold. The narrow one has fewer words that repeat, so
    both are tried.
    """
    return [(max(0, i - k - slack), min(n, i - k + size + slack)) for slack in (max(2, size // 4), size)]


def _pick(matches: set[tuple[int, float, int, int, str]]) -> list[tuple[int, float, int, int, str]]:
    """Of overlapping matches (pairs, share, first, last, name) the one with more pairs, then the shorter, then the earlier."""
    starts: list[int] = []
    ends: list[int] = []
    out = []
    for m in sorted(matches, key=lambda m: (-m[0], m[3] - m[2], -m[1], m[2], m[4])):
        at = bisect_left(starts, m[2])
        if (at < len(starts) and starts[at] <= m[3]) or (at and ends[at - 1] >= m[2]):
            continue
        starts.insert(at, m[2])
        ends.insert(at, m[3])
        out.append(m)
    return out


def _characters(raw: bytes) -> np.ndarray:
    """How many characters start before each byte of a text, and in all of it."""
    starts = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    return np.concatenate(([0], np.cumsum(starts)))


def scan_text(text: str | None, templates: tuple[tuple[str, str], ...] = tuple(TEMPLATES.items()), least: float = 0.8) -> list[tuple[str, int, int, float]]:
    """(template, start, end, coverage) of the notices in a text, in code points, none overlapping another.

    Around each cue word, a narrow and a wide stretch of text (see
    ``_windows``) are aligned with the template; a match pairs ``least`` of
    the template's words, within a stretch in which at least half of the words
    are paired. Stretches that lack too many of the template's different words
    are not aligned, as they can't match. Of overlapping
    matches the one with more paired words stays.
    """
    templates_words, cues = _prepared(templates, least)
    foreign = {name: frozenset(FOREIGN.get(name, "").encode().split()) for name, _ in templates}
    telling = {name: frozenset(TELLING.get(name, "").encode().split()) for name, _ in templates}
    found = words_of(text or "")
    hits = [i for i, (w, _, _) in enumerate(found) if w in cues]
    if not hits:
        return []
    words = [w for w, _, _ in found]
    tried, matches = set(), set()
    for i in hits:
        for name, k in cues[words[i]]:
            own, different, needed = templates_words[name]
            for lo, hi in _windows(i, k, len(own), len(words)):
                if (name, lo, hi) in tried:
                    continue
                tried.add((name, lo, hi))
                inside = different.intersection(words[lo:hi])
                if len(inside) < needed or not telling[name] <= inside:
                    continue
                pairs = align(words[lo:hi], own)
                if pairs and len(pairs) >= least * len(own) - 1e-9 and telling[name] <= {own[j] for _, j in pairs}:
                    first, last = lo + pairs[0][0], lo + pairs[-1][0]
                    if 2 * len(pairs) >= last - first + 1 and foreign[name].isdisjoint(words[first : last + 1]):
                        matches.add((len(pairs), len(pairs) / len(own), first, last, name))
    if not matches:
        return []
    out = [(name, found[first][1], found[last][2], share) for _, share, first, last, name in _pick(matches)]
    if not text.isascii():
        place = _characters(text.encode("utf-8", "surrogatepass"))
        out = [(n, int(place[a]), int(place[b]), c) for n, a, b, c in out]
    return sorted(out, key=lambda m: (m[1], m[0]))


SCHEMA = "doc_id long, n_matches long, license string, coverage double, spans string"


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """Notices and grants in each row of ``docs`` (doc_id, text); one row out for each row in.

    license and coverage are those of the longest match (null: none); spans
    lists all as template:start:end:coverage, comma-joined, in code points.
    Null and empty texts match nothing; null and repeated ids are passed on;
    other columns are ignored.
    """
    known = tuple((templates or TEMPLATES).items())

    def run(batches):
        for batch in batches:
            for part in split_table(batch, 1_000_000):
                rows = []
                for text in part.column("text").to_pylist():
                    m = scan_text(text, known, least)
                    best = max(m, key=lambda x: (x[2] - x[1], x[3], -x[1]), default=(None, 0, 0, None))
                    rows.append((len(m), best[0], best[3], ",".join(f"{n}:{a}:{b}:{c:.3f}" for n, a, b, c in m)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, cols, (pa.int64(), pa.string(), pa.float64(), pa.string()))], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
