"""License scan by patience alignment.

A license template is aligned with a stretch of a text's words as patience diff does it: words that
occur exactly once in both are anchors, the longest increasing subsequence of their places is kept,
and the gaps between kept anchors are aligned the same way after equal words at their two ends are
matched. Coverage is the share of the template's words that were aligned.

Words repeat in a long text, so nothing would be unique in it as a whole. A template of m words is
therefore aligned with stretches of the text: one of 3m/2 words starting at every m/2 words, so that any
copy of the template lies in one of them, and one starting wherever the template's first word occurs, so that a
copy is seen by itself even if another follows at once. Stretches holding too few words of the
template to reach the threshold are passed over, and so are texts in which too many of its words do
not occur even as substrings; both tests are upper bounds of coverage, so no license is missed by them.

Every text is scanned whole, by itself, in the task that reads it; there is no shuffle.

A template's naming words (``NAMING``: what tells its license from its neighbours, such as the abbreviation and the
version) must all be aligned, each phrase of them with consecutive words of the text, so that the one word that
differs in another license's notice, or is put in between, is never among those that may be missing.

Defined results: a null, empty or blank text has no license (null name, coverage 0, no places). All templates found
are listed, each with all its places that do not overlap (better ones first, then earlier ones). The one with the
highest coverage is reported besides, then the longest, then the first in the list, with its first best place. A text may
hold a longer and a shorter wording of one notice; both are listed. Repeated rows repeat; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# The wording of common license notices.
TEMPLATES: Mapping[str, str] = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so."),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    # neighbours of the licenses above: the same wording but for the words that name them
    "Apache": "Released under the Apache License.",
    "BSD": "Released under the BSD License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-v2": "This work is licensed under the GNU General Public License v2.",
    "GPL-3.0-v3": "This work is licensed under the GNU General Public License v3.",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-SA-4.0-long": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0-long": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
}

# The words without which a notice is another license's; words of one phrase follow each other.
NAMING: Mapping[str, tuple[str, ...]] = {
    "MIT": ("mit",),
    "Apache-2.0": ("apache", "2.0"),
    "GPL-3.0": ("gnu general public license", "version 3"),
    "CC-BY-NC-4.0": ("cc by nc 4.0",),
    "CC-BY-4.0": ("attribution 4.0",),
    "MPL-2.0": ("mozilla", "2.0"),
    "BSD-3-Clause": ("bsd",),
    "Apache-2.0-header": ("apache", "2.0"),
    "GPL-3.0-header": ("gnu general public license", "version 3"),
    "Apache": ("apache",),
    "BSD": ("bsd",),
    "GPL-2.0": ("gnu general public license", "version 2"),
    "GPL-2.0-v2": ("gnu general public license", "v2"),
    "GPL-3.0-v3": ("gnu general public license", "v3"),
    "LGPL-2.1": ("gnu lesser general public license", "version 2.1"),
    "LGPL-3.0": ("gnu lesser general public license", "version 3"),
    "AGPL-3.0": ("gnu affero general public license", "version 3"),
    "CC-BY-4.0-short": ("cc by 4.0",),
    "CC-BY-SA-4.0": ("cc by sa 4.0",),
    "CC-BY-ND-4.0": ("cc by nd 4.0",),
    "CC-BY-NC-SA-4.0": ("cc by nc sa 4.0",),
    "CC-BY-NC-ND-4.0": ("cc by nc nd 4.0",),
    "CC-BY-SA-4.0-long": ("attribution sharealike 4.0",),
    "CC-BY-NC-4.0-long": ("attribution noncommercial 4.0",),
}
WORD = re.compile(r"\w+(?:\.\w+)*")


def words_of(text: str) -> list[str]:
    """Lower-cased words; dots inside a word stay, other punctuation goes."""
    return WORD.findall(text.lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    pile: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        at = bisect_left(tops, v)
        back[i] = pile[at - 1] if at else -1
        if at == len(tops):
            tops.append(v)
            pile.append(i)
        else:
            tops[at], pile[at] = v, i
    out, i = [], pile[-1] if pile else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment: increasing pairs (place in a, place in b) of equal words."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        once = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        anchors = [once[k] for k in longest_increasing([j for _, j in once])]
        found.extend(anchors)
        if anchors:
            for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
                todo.append((i + 1, k, j + 1, m))
    return sorted(found)


def _phrases(template: list[str], naming: tuple[str, ...]) -> list[tuple[int, int]]:
    """First and last place in the template of each naming phrase."""
    out = []
    for words in map(str.split, naming):
        at = next((i for i in range(len(template)) if template[i:i + len(words)] == words), None)
        if at is None:
            raise ValueError(f"the naming phrase {' '.join(words)!r} is not in its template")
        out.append((at, at + len(words) - 1))
    return out


class Scanner:
    """The templates, prepared once per task."""

    def __init__(self, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
                 naming: Mapping[str, tuple[str, ...]] | None = None) -> None:
        self.threshold = threshold
        self.prepared = []
        for name, text in templates.items():
            words = words_of(text)
            count = Counter(words)
            # the built-in naming words are for the built-in wording only, not for another template of that name
            named = naming.get(name, ()) if naming is not None else NAMING.get(name, ()) if text == TEMPLATES.get(name) else ()
            # long words first: the test that rejects most texts soonest
            self.prepared.append((name, words, sorted(count.items(), key=lambda x: (-len(x[0]), x[0])),
                                  sorted({w for p in named for w in p.split()}, key=lambda w: (-len(w), w)), _phrases(words, named)))

    def _may_hold(self, text: str, words: list[str], counts: list[tuple[str, int]], named: list[str]) -> bool:
        if any(word not in text for word in named):
            return False
        spare = len(words) * (1 - self.threshold) + 1e-9
        for word, n in counts:
            if word not in text:
                spare -= n
                if spare < 0:
                    return False
        return True

    def _hits(self, text: list[str], template: list[str], phrases: list[tuple[int, int]]) -> list[tuple[float, int, int, int]]:
        """(coverage, words aligned, first place, last place) of all places, best first; none overlap."""
        m, own = len(template), set(template)
        hits = [0]
        for w in text:
            hits.append(hits[-1] + (w in own))
        step, width = max(1, m // 2), m + (m + 1) // 2
        starts = set(range(0, max(1, len(text) - m + step), step)) | {i for i, w in enumerate(text) if w == template[0]}
        found, need = set(), self.threshold * m - 1e-9
        for at in sorted(starts):
            end = min(len(text), at + width)
            if hits[end] - hits[min(at, end)] < need:
                continue
            pairs = align(template, text[at:end])
            if len(pairs) < need:
                continue
            place = dict(pairs)
            if all(place.get(k, -1) == place.get(a, -2) + k - a for a, b in phrases for k in range(a, b + 1)):
                found.add((-len(pairs), at + pairs[0][1], at + pairs[-1][1]))
        taken: list[tuple[int, int]] = []  # places by their first word
        out = []
        for n, first, last in sorted(found):
            i = bisect_left(taken, (first, last))
            if (i == 0 or taken[i - 1][1] < first) and (i == len(taken) or last < taken[i][0]):
                taken.insert(i, (first, last))
                out.append((-n / m, -n, first, last))
        return out

    def scan_all(self, text: str | None) -> list[tuple[str, list[tuple[float, int, int, int]]]]:
        """(license, places) of every license found, best first; a place is (coverage, words aligned, first place, last place)."""
        low = (text or "").lower()
        possible = [x for x in self.prepared if self._may_hold(low, *x[1:4])]
        if not possible:
            return []
        words = words_of(low)
        found = [(-hits[0][0], -len(template), order, (name, hits)) for order, (name, template, *_, phrases) in enumerate(possible)
                 if template and (hits := self._hits(words, template, phrases))]
        return [x[3] for x in sorted(found)]

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, words aligned, first place, last place) of every license found, best first."""
        return [(name, *hits[0]) for name, hits in self.scan_all(text)]


LISTED = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("n_aligned", pa.int64()),
                             ("first_word", pa.int64()), ("last_word", pa.int64())]))


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text", naming: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``naming`` gives, by template, the phrases that must all be found as they are, such as a version; without it the built-in
    ones hold for the built-in templates. A phrase must stand in its template. Per row: id, license, coverage, n_aligned, first_word, last_word (places of words in the text), n_found, and
    found: these five for every place of every license, the best license first."""
    wording, names_of = dict(templates), None if naming is None else dict(naming)
    Scanner(wording, threshold, names_of)  # a phrase that isn't in its template raises here
    kind = dict(docs.dtypes)[id_col]
    names = LISTED.value_type.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(wording, threshold, names_of)
        for batch in batches:
            rows, listed = [], []
            for text in batch.column(1):
                found = scanner.scan_all(text.as_py())
                best = (found[0][0], *found[0][1][0]) if found else (None, 0.0, 0, None, None)
                rows.append((*best, len(found)))
                listed.append([dict(zip(names, (name, *hit))) for name, hits in found for hit in hits])
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types)), pa.array(listed, LISTED)],
                [id_col, *names, "n_found", "found"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"{id_col} {kind}, license string, coverage double, n_aligned bigint, first_word bigint, "
             "last_word bigint, n_found bigint, found array<struct<license: string, coverage: double, n_aligned: bigint, "
             "first_word: bigint, last_word: bigint>>")
