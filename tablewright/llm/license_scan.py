"""Licences in documents, by the Dice coefficient of word bigrams.

Texts are normalised (A-Z in lower case, anything but letters and digits is a
blank). A run of words is compared with the licence templates as multisets of
word bigrams; twice the shared ones, divided by all of both, must reach the
threshold. That needs sizes within a factor of each other, which prunes most
templates, and enough bigrams that occur in the template at all, which prunes
most runs without comparing them.

Every line, every paragraph and the whole text are compared as units. Beside
them every window of words is, wherever it begins and ends, across lines and
paragraphs. A window's coefficient grows when an end that the template lacks
is taken off, so the best windows begin and end with bigrams of the template,
and only windows between such bigrams have to be looked at.

Versions and variants of a licence differ in few words, so their texts match
each other's templates. Some words must therefore stand in a match, or must
not: a window that breaks its template's rule is none, and a unit is marked as
one that is not named. A match inside that of a much larger template belongs
to the larger text.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import license_texts
from tablewright.llm.textbytes import Texts, batches_of, lower_ascii, mixed

THRESHOLD = 0.8

# Licence texts and the notices by which documents name them.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR
A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
}
_MORE, RULES = license_texts.build(TEMPLATES)
TEMPLATES |= _MORE
# Templates whose sizes are within this factor are looked for together.
BUCKET = 1.25

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def normalised_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and start of every word of the texts, and the first word of each text (and the end).

    Letters beyond ASCII are letters; general punctuation such as curly quotes
    and dashes, and the copyright sign, are blanks.
    """
    data = texts.data
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts.offsets), np.int64)
    inside = _WORD[data]
    quotes = np.flatnonzero((data[:-1] == 0xE2) & (data[1:] == 0x80))
    for i in range(3):
        inside[np.minimum(quotes + i, len(data) - 1)] = False
    signs = np.flatnonzero((data[:-1] == 0xC2) & ((data[1:] == 0xA9) | (data[1:] == 0xA0)))
    inside[signs] = inside[signs + 1] = False
    begins = texts.starts()
    start = np.flatnonzero(inside & (~np.append(False, inside[:-1]) | begins))
    end = np.flatnonzero(inside & (~np.append(inside[1:], False) | np.append(begins[1:], True))) + 1
    lower = Texts(lower_ascii(data), texts.offsets)
    return lower.spans_hash(lower.prefix(), start, end), start, np.searchsorted(start, texts.offsets)


def bigrams(words: np.ndarray) -> np.ndarray:
    return mixed(mixed(words[:-1]) + words[1:]) if len(words) > 1 else words[:0]


def units(texts: Texts, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word after the last, and text of every distinct line, paragraph and whole text with two words or more."""
    offsets = texts.offsets
    breaks = np.flatnonzero(texts.data == 0x0A)
    line = np.union1d(offsets[:-1], breaks + 1)
    line = line[line < max(len(texts.data), 1)]
    a, b = np.searchsorted(start, line), np.searchsorted(start, np.append(line[1:], len(texts.data)))
    doc = np.searchsorted(offsets, line, "right") - 1
    worded = b > a
    # a paragraph is a run of lines with words
    fresh = worded.copy()
    fresh[1:] &= ~worded[:-1] | (doc[1:] != doc[:-1])
    stop = worded.copy()
    stop[:-1] &= ~worded[1:] | (doc[1:] != doc[:-1])
    whole = np.searchsorted(start, offsets)
    found = np.stack(
        [
            np.concatenate([a[worded], a[fresh], whole[:-1]]),
            np.concatenate([b[worded], b[stop], whole[1:]]),
            np.concatenate([doc[worded], doc[fresh], np.arange(len(texts))]),
        ]
    )
    found = np.unique(found[:, found[1] - found[0] > 1], axis=1)
    return found[0], found[1], found[2]


class Templates:
    """Licence templates as multisets of bigrams, in order of size."""

    def __init__(self, texts: Mapping[str, str], threshold: float):
        self.threshold = threshold
        self.bags: list[tuple[int, str, Counter]] = []
        for name, text in texts.items():
            raw = np.frombuffer(text.encode(), np.uint8)
            words, _, _ = normalised_words(Texts(raw, np.array([0, len(raw)])))
            bag = Counter(bigrams(words).tolist())
            self.bags.append((sum(bag.values()), name, bag))
        self.bags.sort(key=lambda t: t[:2])
        self.sizes = np.array([n for n, _, _ in self.bags])
        self.known = np.array(sorted({g for _, _, bag in self.bags for g in bag}), np.uint64)
        # fewest bigrams that a window shares, and most that it has
        self.least = np.ceil(self.sizes * threshold / (2 - threshold) - 1e-9).astype(np.int64)
        self.most = np.floor(self.sizes * (2 - threshold) / threshold + 1e-9).astype(np.int64)
        self.size_of = {name: n for n, name, _ in self.bags}
        self.rules = {name: RULES.get(name) for name, text in texts.items() if TEMPLATES.get(name) == text}
        index = {g: i for i, g in enumerate(self.known.tolist())}
        self.buckets = []
        low = 0
        for high in range(1, len(self.bags) + 1):
            if high < len(self.bags) and self.sizes[high] <= BUCKET * self.sizes[low]:
                continue
            # of each known bigram, the templates of the bucket that hold it, and how often
            held = sorted((index[g], k, n) for k in range(low, high) for g, n in self.bags[k][2].items())
            gram, of, often = np.array(held, np.int64).reshape(-1, 3).T
            self.buckets.append((low, high, np.searchsorted(gram, np.arange(len(self.known) + 1)), of, often))
            low = high

    def within(self, size: int) -> slice:
        """The templates whose size allows the threshold: a factor of (2 - t) / t at most."""
        t = self.threshold
        low, high = size * t / (2 - t), size * (2 - t) / t
        return slice(int(np.searchsorted(self.sizes, low - 1e-9)), int(np.searchsorted(self.sizes, high + 1e-9, "right")))

    def compare(self, grams: np.ndarray) -> list[tuple[str, float]]:
        """The templates that a unit with these bigrams matches, and their coefficients."""
        bag, out = None, []
        for size, name, other in self.bags[self.within(len(grams))]:
            bag = bag or Counter(grams.tolist())
            dice = 2 * sum(min(n, bag.get(g, 0)) for g, n in other.items()) / (size + len(grams))
            if dice >= self.threshold:
                out.append((name, dice))
        return out


def windows(at: np.ndarray, hit: np.ndarray, ends: np.ndarray, templates: Templates) -> Iterator[tuple[int, float, int, int]]:
    """(template, coefficient, first bigram, last bigram) of the best windows that match.

    ``hit`` are the places of known bigrams and ``at`` their numbers, ``ends``
    the place after the last bigram of the text of each. The window with the
    largest coefficient is taken (then the first, then the shortest), then the
    best of those that share no word with it, and so on, for every template.
    """
    for low, high, holders, held_by, held in templates.buckets:
        # only runs of bigrams that are long and dense enough for a template of these sizes
        inside = np.flatnonzero(holders[at + 1] > holders[at])
        if len(inside) < max(templates.least[low], 1):
            continue
        place = hit[inside]
        reach = np.searchsorted(place, np.minimum(place + templates.most[high - 1], ends[inside]))
        good = np.flatnonzero(reach - np.arange(len(place)) >= templates.least[low])
        depth = np.bincount(good, minlength=len(place) + 1) - np.bincount(reach[good], minlength=len(place) + 1)
        use = inside[np.cumsum(depth[:-1]) > 0]
        if len(use):
            yield from _best_windows(at[use], hit[use], ends[use], templates, holders, held_by, held)


def _best_windows(at, hit, ends, templates: Templates, holders, held_by, held) -> Iterator[tuple[int, float, int, int]]:
    count = holders[at + 1] - holders[at]
    where = np.repeat(holders[at] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
    kind, often = held_by[where], held[where]
    place, gram, end = np.repeat(hit, count), np.repeat(at, count), np.repeat(ends, count)
    # a bigram counts unless its window holds it as often before it as the template does
    order = np.lexsort((place, gram, kind))
    kind, place, gram, end, often = kind[order], place[order], gram[order], end[order], often[order]
    before = np.arange(len(kind)) - often
    same = (before >= 0) & (kind[before] == kind) & (gram[before] == gram)
    back = np.where(same, place[np.maximum(before, 0)], -1)
    order = np.lexsort((place, kind))
    kind, place, end, back = kind[order], place[order], end[order], back[order]
    width = int(place.max(initial=0)) + int(templates.most.max(initial=0)) + 2
    key = kind * width + place
    reach = np.searchsorted(key, kind * width + np.minimum(place + templates.most[kind], end))
    enough = reach - np.arange(len(kind)) >= templates.least[kind]

    def best(i: int, stop: int) -> tuple[float, int, int] | None:
        """The best window from the i-th bigram on whose last bigram is before ``stop``."""
        to = min(int(reach[i]), int(np.searchsorted(key, kind[i] * width + stop)))
        if to - i < templates.least[kind[i]]:
            return None
        shared = np.cumsum(back[i:to] < place[i])
        dice = 2 * shared / (templates.sizes[kind[i]] + place[i:to] - place[i] + 1)
        top = int(dice.argmax())
        return (-float(dice[top]), i, i + top) if dice[top] >= templates.threshold else None

    # windows meet only in the same text and template
    groups: dict[tuple[int, int], list[tuple[float, int, int]]] = defaultdict(list)
    for i in np.flatnonzero(enough).tolist():
        if found := best(i, int(end[i])):
            groups[int(kind[i]), int(end[i])].append(found)
    for (k, _), heap in groups.items():
        heapq.heapify(heap)
        taken: list[tuple[int, int]] = []  # bigrams from and to, in order; those next to each other share a word
        while heap:
            dice, i, j = heapq.heappop(heap)
            a, b = int(place[i]), int(place[j])
            after = bisect_right(taken, a + 1, key=lambda w: w[0])
            if after and a <= taken[after - 1][1] + 1:
                continue
            if after < len(taken) and taken[after][0] <= b + 1:
                if found := best(i, taken[after][0] - 1):
                    heapq.heappush(heap, found)
                continue
            taken.insert(after, (a, b))
            yield k, -dice, a, b


def matches(texts: Texts, templates: Templates) -> Iterator[tuple[int, str, float, int, int, bool]]:
    """(text, licence, coefficient, first byte, byte after the last, named) of every unit that matches, and of better windows."""
    found: dict[int, list[tuple[str, float, int, int, bool]]] = defaultdict(list)
    for doc, *match in _all_matches(texts, templates):
        found[doc].append(tuple(match))
    for doc, of in found.items():
        for match in outermost(of, templates):
            yield doc, *match


def outermost(found: list[tuple[str, float, int, int, bool]], templates: Templates) -> list[tuple[str, float, int, int, bool]]:
    """Without the matches inside a named one of a template too large to be near theirs."""
    large = sorted((a, b, templates.size_of[name]) for name, _, a, b, named in found if named)
    a, b, size = np.array(large, np.int64).reshape(-1, 3).T
    longest = int((b - a).max(initial=0))
    near = (2 - templates.threshold) / templates.threshold
    out = []
    for match in found:
        name, _, x, y, _ = match
        s = slice(int(np.searchsorted(a, y - longest)), int(np.searchsorted(a, x, "right")))
        if not ((b[s] >= y) & (b[s] - a[s] > y - x) & (size[s] > near * templates.size_of[name])).any():
            out.append(match)
    return out


def _all_matches(texts: Texts, templates: Templates) -> Iterator[tuple[int, str, float, int, int, bool]]:
    words, start, first = normalised_words(texts)
    grams = bigrams(words)
    if not len(grams) or not len(templates.known):
        return
    at = np.minimum(np.searchsorted(templates.known, grams), len(templates.known) - 1)
    hit = templates.known[at] == grams
    hits = np.concatenate([[0], np.cumsum(hit)])

    def span(doc: int, a: int, b: int) -> tuple[int, int]:
        """Bytes of the words from ``a`` to before ``b``."""
        base = int(texts.offsets[doc])
        stop = int(start[b]) if b < len(start) else len(texts.data)
        stop = min(stop, int(texts.offsets[doc + 1]))
        text = texts.data[start[a] : stop].tobytes().rstrip(b" \t\n\v\f\r")
        return int(start[a]) - base, int(start[a]) - base + len(text)

    def named(name: str, doc: int, x: int, y: int) -> bool:
        base = int(texts.offsets[doc])
        rule = templates.rules.get(name)
        return rule is None or license_texts.agrees(rule, texts.data[base + x : base + y].tobytes().decode(errors="replace"))

    a, b, doc = units(texts, start)
    size, shared = b - a - 1, hits[b - 1] - hits[a]
    t = templates.threshold
    least = np.maximum(templates.sizes[0], size * t / (2 - t))  # of a template that could match
    found = defaultdict(list)  # words from, to before, and coefficient of the units by text and licence
    for i in np.flatnonzero(2 * np.minimum(shared, size) >= t * (size + least) - 1e-9).tolist():
        for name, dice in templates.compare(grams[a[i] : b[i] - 1]):
            found[int(doc[i]), name].append((int(a[i]), int(b[i]), dice))
            x, y = span(int(doc[i]), int(a[i]), int(b[i]))
            yield int(doc[i]), name, dice, x, y, named(name, int(doc[i]), x, y)

    # the last word of a text begins no bigram
    text_of = np.searchsorted(first, np.arange(len(grams)), "right") - 1
    hit &= np.arange(len(grams)) + 1 < first[text_of + 1]
    places = np.flatnonzero(hit)
    for k, dice, x, y in windows(at[places], places, first[text_of[places] + 1] - 1, templates):
        name, of = templates.bags[k][1], int(text_of[x])
        if not any(u <= y + 1 and x < v and d >= dice for u, v, d in found.get((of, name), ())):
            x, y = span(of, x, y + 2)
            if named(name, of, x, y):
                yield of, name, dice, x, y, True


def _scanner(texts_of: dict[str, str], threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(texts_of, threshold)
        kind = pa.list_(
            pa.struct([("license", pa.string()), ("dice", pa.float64()), ("from", pa.int64()), ("to", pa.int64()), ("named", pa.bool_())])
        )
        for batch, texts in batches_of(batches, "_text"):
            found: list[list[dict]] = [[] for _ in range(len(texts))]
            for doc, name, dice, a, b, named in matches(texts, templates):
                found[doc].append({"license": name, "dice": dice, "from": a, "to": b, "named": named})
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found, kind)], names=["_id", "matches"])

    return run


def scan(
    docs: DataFrame, id_column: str, text: str, templates: Mapping[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """id and matches (licence, dice, bytes from and to, named) of every row, with an empty list where nothing matches.

    All units of the whole text are looked at, and all windows of words; of
    windows that share words the best is reported, if no unit there is as good.
    Where ``named`` is false, the words that tell versions and variants apart
    speak against the licence. A missing or empty text matches
    nothing, as does a unit of fewer than two words. Rows that share an id are
    scanned each, a missing id is passed on. Other columns are not read. An
    empty table gives an empty one.
    """
    flat = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    kind = flat.schema["_id"].dataType.simpleString()
    out = flat.mapInArrow(
        _scanner(dict(templates or TEMPLATES), threshold),
        f"_id {kind}, matches array<struct<license:string,dice:double,from:bigint,to:bigint,named:boolean>>",
    )
    return out.withColumnRenamed("_id", id_column)


def best_license(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """id, the licence with the largest coefficient (then the first by name), it, where it stands, and the number of matches, of those that are named."""
    named = F.filter("matches", lambda m: m["named"])
    ordered = F.array_sort(
        F.transform(named, lambda m: F.struct(
            (-m["dice"]).alias("d"), m["license"].alias("n"), m["from"].alias("a"), m["to"].alias("b")))
    )
    best = F.try_element_at(ordered, F.lit(1))
    return scanned.select(
        id_column, best["n"].alias("license"), F.round(-best["d"], 6).alias("dice"), best["a"].alias("license_from"),
        best["b"].alias("license_to"), F.size(named).alias("n_matches"),
    )
