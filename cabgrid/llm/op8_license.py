"""License scans: MinHash bands over overlapping windows (operator 8).

Templates (license notices and whole license texts) and texts become five-word
shingles, A-Z lower-cased; punctuation at the edges of a word and words of
punctuation only (comment markers, bullets, rules) do not count. A template of
n shingles is looked for in windows of blocks of about n / 3 shingles, each
window one block after the last, long enough for any occurrence with a quarter
more words. Retrieval: BANDS MinHash bands of one row each; a window whose
minimum equals the template's in any band is a candidate. An occurrence with
CONTAINMENT of the shingles has a Jaccard similarity of at least 0.25 with its
window, so it is missed with a probability below 0.75 ** 48 = 1e-6.
Verification: in the candidate windows, the largest share of the template's
distinct shingles in any span of ceil(1.25 n) consecutive shingles, on exact
shingles, must reach CONTAINMENT. Of overlapping spans the one that explains
most shingles wins, then the higher containment: a whole text beats the notice
it opens with, a license its near relatives. A template's row is its best span
among the winners.

Edge cases: null and empty texts, and those of fewer than five words, match
nothing; texts of any length are scanned whole, spans never cross documents;
templates of fewer than five words are refused; repeated rows and null ids
give their rows like any other; other columns of any name are ignored; empty
tables give empty results.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .textscan import Shingles, bytes_of, chunks, mix64

WORDS = 5
CONTAINMENT = 0.8
BANDS = 48
SPAN = 1.25

# Public license notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0 terms."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]

# Notices of further families, and whole texts. The notices of several licenses differ in a word or two.
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} General "
        "Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) "
        "any later version.")
_GNU_LIBRARY = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                "Public License as published by the Free Software Foundation; either version {0} of the License, or (at your "
                "option) any later version.")
MORE_NOTICES = [
    ("AGPL-3.0", _GNU.format("Affero", "3")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", _GNU.format("Lesser", "3")),
    ("LGPL-3.0", _GNU_LIBRARY.format("3")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", _GNU.format("Lesser", "2.1")),
    ("LGPL-2.1", _GNU_LIBRARY.format("2.1")),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "v. 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the "
                "Eclipse Public License v1.0 which accompanies this distribution, and is available at "
                "http://www.eclipse.org/legal/epl-v10.html"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
                "to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
WHOLE = ["AGPL-3.0", "Apache-2.0", "Artistic", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "EPL-1.0", "GPL-2.0", "GPL-3.0", "ISC",
         "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib"]

U = np.uint64


def all_templates() -> list[tuple[str, str]]:
    """(license, text) of the notices and of the whole texts in ``licenses/``."""
    folder = files(__package__) / "licenses"
    return [*TEMPLATES, *MORE_NOTICES, *((name, (folder / f"{name}.txt").read_text("utf-8")) for name in WHOLE)]


class Template:
    def __init__(self, number: int, text: str):
        data = np.frombuffer(text.encode(), np.uint8)
        found = Shingles(data, np.array([0, len(data)]), WORDS, strip=True)
        if not len(found.hashes):
            raise ValueError(f"a template needs {WORDS} words: {text!r}")
        self.number = number
        self.shingles = np.unique(found.hashes)
        n = len(found.hashes)
        self.span = int(np.ceil(SPAN * n))
        self.block = 1 << max(0, int(np.log2(max(1, n // 2))))
        self.blocks = -(-self.span // self.block) + 1
        self.minima = np.array([band_hash(self.shingles, b).min() for b in range(BANDS)], np.uint32)


def band_hash(shingles: np.ndarray, band: int) -> np.ndarray:
    """32 bits of a multiply-shift hash of the (mixed) shingle, per band."""
    odd = int(mix64(np.array([band + 1], U) * U(0x9E3779B97F4A7C15))[0]) | 1
    return (shingles * U(odd) >> U(32)).astype(np.uint32)


def candidates(hashes: np.ndarray, templates: list[Template]) -> list[np.ndarray]:
    """Per template the block numbers at which windows share a band with it."""
    found = [np.zeros(0, bool)] * len(templates)
    sizes = sorted({t.block for t in templates})
    for i, t in enumerate(templates):
        found[i] = np.zeros(-(-len(hashes) // t.block), bool)
    for band in range(BANDS):
        minima, size = band_hash(hashes, band), 1
        for block in sizes:
            if block > size:
                minima = np.minimum.reduceat(minima, np.arange(0, len(minima), block // size))
                size = block
            for i, t in enumerate(templates):
                if t.block == block:
                    # the window's minimum is the template's: it holds it, and nothing smaller
                    for at in np.flatnonzero(minima == t.minima[band]):
                        lo = max(0, at - t.blocks + 1)
                        below = np.flatnonzero(minima[lo:at + t.blocks] < t.minima[band]) + lo
                        before = below[below < at].max(initial=lo - 1)
                        after = below[below > at].min(initial=at + t.blocks)
                        first = np.arange(max(lo, before + 1), at + 1)
                        found[i][first[first + t.blocks <= after]] = True
                        if at + t.blocks >= len(minima):  # windows cut off by the end
                            found[i][first[(first + t.blocks > len(minima)) & (after >= len(minima))]] = True
    return [np.flatnonzero(f) for f in found]


def spans(ids: list[int], at: list[int], row: list[int], t: Template) -> Iterator[tuple[int, int, int, int]]:
    """(row, distinct shingles, first, last shingle) of the spans that hold
    CONTAINMENT of the template, one for each place ``at`` of a shingle of it
    (number ``ids`` in the template), from there to the last one that adds one."""
    count = [0] * len(t.shingles)
    q = distinct = 0
    for i, p in enumerate(at):
        while q < len(at) and at[q] < p + t.span and row[q] == row[i]:
            distinct += not count[ids[q]]
            count[ids[q]] += 1
            q += 1
        if distinct >= CONTAINMENT * len(t.shingles):
            last, spare = q - 1, {}
            while count[ids[last]] - spare.get(ids[last], 0) > 1:
                spare[ids[last]] = spare.get(ids[last], 0) + 1
                last -= 1
            yield row[i], distinct, p, at[last]
        count[ids[i]] -= 1
        distinct -= not count[ids[i]]


def winners(found: list[tuple[int, float, int, int, int]]) -> Iterator[tuple[int, float, int, int, int]]:
    """Of spans (distinct shingles, containment, template, first, last word)
    of one row each template's best that no better span overlaps."""
    taken: list[tuple[int, int]] = []
    done = set()
    for s in sorted(found, key=lambda s: (-s[0], -s[1], s[4] - s[3], s[3], s[2])):
        i = bisect_left(taken, (s[3], s[4]))
        if (i == len(taken) or taken[i][0] > s[4]) and (not i or taken[i - 1][1] < s[3]):
            taken.insert(i, (s[3], s[4]))
            if s[2] not in done:
                done.add(s[2])
                yield s


def scan_rows(data: np.ndarray, offsets: np.ndarray, templates: list[Template]):
    """(row, template, containment, first byte, end byte) of each template a
    row of the chunk holds, at its best span (the first of the best)."""
    s = Shingles(data, offsets, WORDS, strip=True)
    if not len(s.hashes):
        return
    hashes, whole = s.hashes, s.whole
    rows = np.searchsorted(s.cut, np.arange(len(hashes)), "right") - 1
    found: dict[int, list[tuple[int, float, int, int, int]]] = {}
    for t, windows in zip(templates, candidates(hashes, templates)):
        if not len(windows):
            continue
        inside = np.zeros(len(hashes) + 1, np.int32)
        np.add.at(inside, windows * t.block, 1)
        np.add.at(inside, np.minimum((windows + t.blocks) * t.block, len(hashes)), -1)
        at = np.flatnonzero((np.cumsum(inside)[:-1] > 0) & whole)
        at = at[np.isin(hashes[at], t.shingles)]
        ids = np.searchsorted(t.shingles, hashes[at])
        for row, distinct, first, last in spans(ids.tolist(), at.tolist(), rows[at].tolist(), t):
            found.setdefault(row, []).append((distinct, distinct / len(t.shingles), t.number, first, last + WORDS - 1))
    for row, of in found.items():
        begin = offsets[row] - offsets[0]
        for _, share, number, first, last in winners(of):
            yield row, number, share, int(s.start[first] - begin), int(s.end[last] - begin)


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) and template found (of
    ``all_templates()``, if none are given): doc_id, license, template (its
    number), containment, first_byte, end_byte (of the best span in the text's
    UTF-8 bytes)."""
    templates = all_templates() if templates is None else templates
    names = [name for name, _ in templates]
    texts = [text for _, text in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Template(i, t) for i, t in enumerate(texts)]
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            ids = batch.column(0).to_pylist()
            for a, b in chunks(offsets):
                out = list(scan_rows(data, offsets[a:b + 1], ready))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[a + r[0]] for r in out], pa.int64()), pa.array([names[r[1]] for r in out], pa.string()),
                     pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.float64()),
                     pa.array([r[3] for r in out], pa.int64()), pa.array([r[4] for r in out], pa.int64())],
                    ["doc_id", "license", "template", "containment", "first_byte", "end_byte"])

    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, license string, template int, containment double, first_byte long, end_byte long"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
