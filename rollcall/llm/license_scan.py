"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies.

Texts and templates are words of letters and digits in lower case, as 5-word shingles. A template of t
shingles belongs to the class of the least power of two L >= t. A match is a run of at most L shingles that
holds THRESHOLD % of the template's; windows of 2L shingles at a stride of L hold every such run whole,
so window and template have a Jaccard similarity of at least j = need / (2L + t - need). A band is one
minimum, and class L takes so many bands that all miss with a probability of at most MISS: 1 - (1 - j)^b.
Minima of long windows are minima of short ones' minima, so all classes cost about one.

A retrieved pair of document and template is verified over the document's exact shingles, so the result
doesn't depend on where windows or batches begin. One pass; nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._session import prepare

SHINGLE = 5
THRESHOLD = 75
MISS = 1e-5

# Notices, identifier lines and whole texts of public licenses, of five words or more. The identifier line
# of a license whose name is one word has four and isn't found.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
)
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        _MIT[0],
        " ".join(_MIT),
    ),
    "Apache-2.0": (
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL": (
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL-3.0": (
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "BSD": (
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
        *_BSD,
        " ".join(_BSD[:3]),
        " ".join(_BSD),
    ),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "ISC": (_ISC[0], " ".join(_ISC)),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
}

# Letters and digits stay, other ASCII becomes a space; bytes of longer code points stay.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.shingles = np.unique(_shingles(text)[1])
        t = len(self.shingles)
        self.need = -(-THRESHOLD * t // 100)
        self.size = 1 << (t - 1).bit_length()
        jaccard = self.need / (2 * self.size + t - self.need)
        self.bands = math.ceil(math.log(MISS) / math.log(1 - jaccard))


def _shingles(text: str) -> tuple[_text.Words, np.ndarray]:
    words = _text.Words(pa.array([text.encode().translate(_PLAIN)], pa.binary()).cast(pa.string()))
    return words, _text.windows(words.hashes(True), SHINGLE)


class Index:
    """Band values of all templates: for each class and band the sorted minima and whose they are."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.templates = [Template(name, text) for name, texts in templates.items() for text in texts]
        self.bands = max(t.bands for t in self.templates)
        rng = np.random.Generator(np.random.PCG64(7))
        self.factors = rng.integers(0, 2**63, self.bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.sizes = sorted({t.size for t in self.templates})
        self.table: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in self.sizes:
            own = [i for i, t in enumerate(self.templates) if t.size == size]
            for band in range(max(self.templates[i].bands for i in own)):
                minima = np.array([(self.templates[i].shingles * self.factors[band]).min() for i in own], np.uint64)
                order = np.argsort(minima)
                seen = np.zeros(1 << 16, bool)
                seen[minima & np.uint64(0xFFFF)] = True
                self.table[size, band] = (minima[order], np.array(own)[order], seen)

    def retrieve(self, shingles: np.ndarray) -> set[tuple[int, int, int]]:
        """(first shingle, end, template) of the windows that share a band with a template."""
        found: set[tuple[int, int, int]] = set()
        for band in range(self.bands if len(shingles) else 0):
            minima, size = shingles * self.factors[band], 1
            while True:
                if (size, band) in self.table:
                    values, own, seen = self.table[size, band]
                    # A window is two neighbouring blocks; its minimum is one of theirs.
                    for block in np.flatnonzero(seen[minima & np.uint64(0xFFFF)]):
                        lo, hi = np.searchsorted(values, minima[block], "left"), np.searchsorted(values, minima[block], "right")
                        for i in own[lo:hi]:
                            found.add((max(0, int(block) - 1) * size, (int(block) + 2) * size, int(i)))
                if size >= self.sizes[-1]:
                    break
                if len(minima) % 2:
                    minima = np.append(minima, np.uint64(2**64 - 1))
                minima, size = np.minimum(minima[::2], minima[1::2]), 2 * size
        return found


def verify(shingles: np.ndarray, template: Template) -> list[tuple[int, int, int]]:
    """(first shingle, last shingle, shared) of the matches in a document: leftmost, shortest, not overlapping."""
    at = np.flatnonzero(np.isin(shingles, template.shingles))
    out: list[tuple[int, int, int]] = []
    counts: dict[int, int] = {}
    low = 0
    for high, p in enumerate(at.tolist()):
        v = int(shingles[p])
        counts[v] = counts.get(v, 0) + 1
        while p - at[low] >= template.size:
            first = int(shingles[at[low]])
            counts[first] -= 1
            if not counts[first]:
                del counts[first]
            low += 1
        if len(counts) >= template.need:
            # Reach on while each next shingle of the template still is within the run.
            out.append((int(at[low]), p, len(counts)))
            counts, low = {}, high + 1
    return _extended(out, at.tolist(), shingles, template)


def _extended(found: list[tuple[int, int, int]], at: list[int], shingles: np.ndarray, template: Template) -> list[tuple[int, int, int]]:
    """Matches grown to the right over directly following template shingles; those that begin inside another are its part."""
    out: list[tuple[int, int, int]] = []
    inside = set(at)
    for first, last, _ in found:
        if out and first <= out[-1][1]:
            continue
        own = {int(shingles[p]) for p in range(first, last + 1) if p in inside}
        while last + 1 in inside and last + 1 - first < template.size:
            last += 1
            own.add(int(shingles[last]))
        out.append((first, last, len(own)))
    return out


@cache
def _index() -> Index:
    return Index(TEMPLATES)


def scan_text(text: str, index: Index, only: set[int] | None = None) -> list[tuple[str, int, int, int]]:
    """(license, start, end, percent of the template found) in code points, by start; `only` names the templates to verify."""
    words, shingles = _shingles(text)
    raw = np.frombuffer(text.encode(), np.uint8)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    out = []
    for i, template in enumerate(index.templates):
        if only is None or i in only:
            for first, last, shared in verify(shingles, template):
                out.append((template.name, int(points[words.starts[first]]), int(points[words.ends[last + SHINGLE - 1]]), 100 * shared // len(template.shingles)))
    merged: list[tuple[str, int, int, int]] = []
    for m in sorted(out):  # matches of one license that overlap are one, of the greatest share
        if merged and merged[-1][0] == m[0] and m[1] < merged[-1][2]:
            name, start, end, percent = merged[-1]
            merged[-1] = (name, start, max(end, m[2]), max(percent, m[3]))
        else:
            merged.append(m)
    return sorted(merged, key=lambda m: (m[1], m[2], m[0]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, matches) of docs(doc_id, text, ...): array<struct<license, start, end, percent>> by start.

    Code points, end exclusive. Null, empty and short texts have no matches; very long ones are scanned whole; rows
    with equal or null ids are scanned each on its own. Two licenses found at one place both stay, in order of start,
    end and name; overlapping matches of one license are one. Extra columns are ignored; an empty table gives an empty
    result.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("percent", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index()
        for batch in batches:
            texts = _text.plain(batch.column(1))
            out: list[list[dict]] = []
            for start, stop in _text.steps(texts):
                own = texts.slice(start, stop - start)
                offsets = _text._offsets(own)
                data = own.buffers()[2]
                raw = (data.to_pybytes()[offsets[0] : offsets[-1]] if data is not None else b"").translate(_PLAIN)
                words = _text.Words(pa.StringArray.from_buffers(len(own), pa.py_buffer((offsets - offsets[0]).astype(np.int32)), pa.py_buffer(raw)))
                shingles = _text.windows(words.hashes(True), SHINGLE)
                wanted: dict[int, set[int]] = {}
                for lo, hi, template in index.retrieve(shingles) if len(shingles) else ():
                    for doc in range(int(np.searchsorted(words.first, lo, "right")) - 1, min(len(own), int(np.searchsorted(words.first, hi, "left")))):
                        wanted.setdefault(doc, set()).add(template)
                for i in range(len(own)):
                    found = scan_text(own[i].as_py(), index, wanted[i]) if i in wanted else []
                    out.append([dict(zip(("license", "start", "end", "percent"), m, strict=True)) for m in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "matches"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, matches array<struct<license:string,start:long,end:long,percent:long>>")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_matches, licenses (distinct, sorted, comma-joined), spans (license:start:end, comma-joined)."""
    return scan(docs).select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.col("matches.license"))), ",").alias("licenses"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"))), ",").alias("spans"),
    )
