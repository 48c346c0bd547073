"""Operator 8: license scans by conditional compression.

1. Candidate blocks: stretches of a text in which a window of a template's length holds all but EDITS of its distinct words, for any template;
   overlapping ones are one block. An occurrence with at most EDITS of its words differing always lies in one, so nothing is lost here.
2. Ranking: a block is compressed with each template that marked it as a raw zstandard dictionary; the more bytes a template saves, the earlier its turn.
3. Confirmation by exact wording: in that order each template's words are aligned with the block's. Where one has no differing word, that is what
   the block holds there. Where words differ, the next ranks are aligned too, and the one with the most words in common takes the place. What is left on either
   side is ranked and confirmed anew, until no template is within its budget; so every occurrence is reported or overlaps a notice that is.
   `saved` is the share of a notice's compressed size that its template saves.

Input cases: null and empty texts have no finding; repeated rows give repeated rows; very
long texts are scanned whole, RUN_WORDS words at a time; ties of saved bytes go to the longer template, then the earlier; empty table: empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from .common import table

#: Public notices by license.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:""",
    ),
)
EDITS = 0.15
RUN_WORDS = 65_536
SHORT_CHARS = 1_000_000  # texts up to it are cut into words at once for the first look
_WORD = re.compile(r"[^\W_]+(?:[-.][^\W_]+)*")


def words_of(text: str) -> Iterator[tuple[str, int, int]]:
    return ((m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text))


def occurrences(item: np.ndarray, text: np.ndarray, most: int) -> Iterator[tuple[int, int, int]]:
    """(differing, start, end) of the best alignment of the whole item that ends at each place, where it is within most."""
    d = np.arange(len(text) + 1)
    cost, start = np.zeros(len(d), np.int64), d
    for word in item.tolist():
        new, came = cost + 1, start  # the item's word is left out
        beside = cost[:-1] + (text != word)
        better = beside <= new[1:]
        came = np.r_[came[0], np.where(better, start[:-1], came[1:])]
        new = np.r_[new[0], np.where(better, beside, new[1:])]
        run = np.minimum.accumulate(new - d) + d  # words of the text between
        cost, start = run, came[np.maximum.accumulate(np.where(new <= run, d, 0))]
        if cost.min() > most:
            return
    for end in np.nonzero((cost <= most) & (start < d))[0].tolist():
        yield int(cost[end]), int(start[end]), end


def whole_cost(item: np.ndarray, text: np.ndarray) -> int:
    """Words in which all of the item and all of the text differ."""
    d = np.arange(len(text) + 1)
    cost = d
    for k, word in enumerate(item.tolist(), 1):
        new = np.r_[k, np.minimum(cost[1:] + 1, cost[:-1] + (text != word))]
        cost = np.minimum.accumulate(new - d) + d
    return int(cost[-1])


class Scanner:
    def __init__(self) -> None:
        self.words = [[w for w, _, _ in words_of(t)] for _, t in TEMPLATES]
        self.most = [int(EDITS * len(w)) for w in self.words]
        self.longest = max(len(w) + 3 * e for w, e in zip(self.words, self.most, strict=True))
        self.sets = [set(w) for w in self.words]
        self.needs = [len(s) - e for s, e in zip(self.sets, self.most, strict=True)]
        self.having: dict[str, list[int]] = {}
        for k, words in enumerate(self.sets):
            for w in words:
                self.having.setdefault(w, []).append(k)
        self.plain = zstandard.ZstdCompressor(level=3)
        kind = zstandard.DICT_TYPE_RAWCONTENT
        self.given = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(t.lower().encode(), dict_type=kind)) for _, t in TEMPLATES]
        self.saved = lru_cache(4096)(self.share_saved)

    def share_saved(self, k: int, notice: str) -> float:
        raw = notice.lower().encode("utf-8", "surrogatepass")
        return 1 - len(self.given[k].compress(raw)) / len(self.plain.compress(raw))

    def able(self, words: set[str]) -> list[int]:
        """Templates of which all but EDITS distinct words are there."""
        n = Counter(k for w in self.having.keys() & words for k in self.having[w])
        return [k for k, need in enumerate(self.needs) if n[k] >= need]

    def runs(self, text: str) -> Iterator[list[tuple[str, int, int]]]:
        """The words in runs of bounded size, which share as many words as a candidate can have."""
        run: list[tuple[str, int, int]] = []
        for word in words_of(text):
            run.append(word)
            if len(run) == RUN_WORDS + self.longest:
                yield run
                run = run[RUN_WORDS:]
        yield run

    def windows(self, k: int, places: list[int], words: list[str]) -> Iterator[tuple[int, int]]:
        """First and last place of stretches of the template's words that hold enough different ones within its length."""
        size, count, first = len(self.words[k]) + self.most[k], Counter(), 0
        for last, at in enumerate(places):
            count[words[last]] += 1
            while at - places[first] >= size:
                count[words[first]] -= 1
                if not count[words[first]]:
                    del count[words[first]]
                first += 1
            if len(count) >= self.needs[k]:
                yield places[first], at

    def blocks(self, text: str) -> list[tuple[int, int, set[int]]]:
        """(start, end, templates) of candidate blocks, in order of place."""
        short = len(text) < SHORT_CHARS
        if not self.able({w.lower() for w in _WORD.findall(text)} if short else {w for w, _, _ in words_of(text)}):
            return []
        marks = []
        for run in self.runs(text):
            at: dict[int, tuple[list[int], list[str]]] = {}
            for place, (w, _, _) in enumerate(run):
                for k in self.having.get(w, ()):
                    places, words = at.setdefault(k, ([], []))
                    places.append(place)
                    words.append(w)
            for k, (places, words) in at.items():
                for a, b in self.windows(k, places, words):
                    a, b = max(0, a - self.most[k]), min(len(run) - 1, b + self.most[k])
                    marks.append((run[a][1], run[b][2], k))
        out: list[tuple[int, int, set[int]]] = []
        for a, b, k in sorted(marks):
            if out and a < out[-1][1]:
                start, end, ks = out[-1]
                out[-1] = (start, max(end, b), ks | {k})
            else:
                out.append((a, b, {k}))
        return out

    def ranked(self, block: str, ks: set[int]) -> list[int]:
        """The templates in order of the bytes that they save of the block, then of their own length."""
        raw = block.lower().encode("utf-8", "surrogatepass")
        return sorted(ks, key=lambda k: (len(self.given[k].compress(raw)), -len(self.words[k]), k))

    def confirmed(self, block: str, ks: set[int]) -> list[tuple[int, int, int, int]]:
        """(start, end, template, differing) of what the ranking's first confirmed template is in the block, apart and in order; empty if none is."""
        there = list(words_of(block))
        number: dict[str, int] = {}
        codes = np.array([number.setdefault(w, len(number)) for w, _, _ in there], np.int64)
        best: list[tuple[int, int, int, int, int, int]] = []
        for turn, k in enumerate(self.ranked(block, ks.intersection(self.able(set(number))))):
            item = np.array([number.get(w, -1) for w in self.words[k]], np.int64)
            found = list(occurrences(item, codes, self.most[k]))
            exact = [o for o in found if not o[0]]
            if exact and not best:
                out, end = [], 0
                for _, a, b in sorted(exact, key=lambda o: (o[2], -o[1])):
                    if a >= end:
                        out.append((there[a][1], there[b - 1][2], k, 0))
                        end = b
                return out
            best += [(len(item) - d, -d, -turn, -a, b, k) for d, a, b in found]
        if not best:
            return []
        rank = max(o[2] for o in best)
        low, high = self.trimmed(max(o for o in best if o[2] == rank), codes, number)  # the first rank's nearest occurrence
        top = max(o for o in best if -o[3] < high and low < o[4])
        low, high = self.trimmed(top, codes, number)
        return [(there[low][1], there[high - 1][2], top[5], -top[1])]

    def trimmed(self, occurrence: tuple[int, ...], codes: np.ndarray, number: dict[str, int]) -> tuple[int, int]:
        """First word and end of an occurrence without words at its ends that are none of the template's: leaving them out costs no more than changing them."""
        _, minus, _, a, b, k = occurrence
        item, a = np.array([number.get(w, -1) for w in self.words[k]], np.int64), -a
        while minus and a + 1 < b and whole_cost(item, codes[a + 1 : b]) <= -minus:
            a += 1
        while minus and a + 1 < b and whole_cost(item, codes[a : b - 1]) <= -minus:
            b -= 1
        return a, b

    def scan(self, text: str) -> list[tuple[str, int, int, float, int]]:
        out = []
        for start, end, ks in self.blocks(text):
            free = [(start, end)]
            while free:
                a, b = free.pop()
                here = [(a + x, a + y, k, differ) for x, y, k, differ in self.confirmed(text[a:b], ks)]
                out += here
                if here:
                    free += zip([a, *(h[1] for h in here)], [*(h[0] for h in here), b], strict=True)
        return [(TEMPLATES[k][0], x, y, round(self.saved(k, text[x:y]), 4), differ) for x, y, k, differ in sorted(out)]


def find_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, license, start, end, saved, differing of each notice in a text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for b in batches:
            rows = [(r, *f) for r, t in enumerate(b.column(1).to_pylist()) if t for f in scanner.scan(t)]
            types = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
            columns = [pa.array([r[c + 1] for r in rows], t) for c, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([r[0] for r in rows], pa.int64())), *columns], ["doc_id", "license", "start", "end", "saved", "differing"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, license string, start int, end int, saved double, differing int")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))
