"""License scan by patience alignment.

A stretch of text is aligned with a license template: words that occur exactly
once in both are anchors; the longest increasing subsequence of the anchors'
positions is kept; the gaps between kept anchors are aligned the same way, until
a gap has no anchor, where equal words at its two ends still count. Coverage is
the share of the template's words that are matched.

A text is not aligned as a whole (a repeated notice would have no unique word),
but in windows. A window is a stretch where the words that also occur in the
template reach the least share of the template's length that a reported match
needs; a running sum finds all such stretches, so none is missed, and a text whose
words cannot reach it is done after one set intersection per template. The sum
weighs no word by place, so several notices in one stretch are cut apart where
the template's words begin anew: windows begin where the template's rarest words say
that a notice begins, the best matches that don't overlap are kept, and what lies
before, between and after them is aligned again.

Defined cases: null or empty texts give no row; a template of few words needs all
but ``max_missing`` of them; a notice that occurs twice gives two rows; a stretch
that several templates cover gives a row for each, unless a match of more words
contains it; rows alike give rows alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables, words

MATCH_SCHEMA = "doc_id long, license string, coverage double, first_word int, end_word int, n_words int"


def longest_increasing(values: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence (patience piles)."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for k, value in enumerate(values):
        pile = bisect_left(tops, value)
        before[k] = at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(value)
            at.append(k)
        else:
            tops[pile], at[pile] = value, k
    out = []
    k = at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def patience(text: list, template: list) -> list[tuple[int, int]]:
    """Matched (text position, template position) pairs, increasing in both."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        # equal words at both ends of the gap
        while a < b and c < d and text[a] == template[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
        if a == b or c == d:
            continue
        once = {w for w, n in Counter(template[c:d]).items() if n == 1}
        counts = Counter(w for w in text[a:b] if w in once)
        place = {w: k for k, w in enumerate(text[a:b], a) if counts.get(w) == 1}
        anchors = [(place[w], k) for k, w in enumerate(template[c:d], c) if w in place]
        kept = [anchors[k] for k in longest_increasing([p for p, _ in anchors])]
        if not kept:
            continue
        matched += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        todo += [(p + 1, q, s + 1, t) for (p, s), (q, t) in zip(edges, edges[1:]) if q > p + 1 and t > s + 1]
    return sorted(matched)


class Template:
    def __init__(self, name: str, text: str, min_coverage: float, min_density: float, max_missing: int):
        self.name = name
        self.words = words.plain_words(text)
        self.known = set(self.words)
        self.times = Counter(self.words)
        size = len(self.words)
        # a short notice is told by nearly all of its words
        self.least = max(math.ceil(min_coverage * size), size - max_missing if size < 20 else 0)
        self.span = math.floor(size / min_density) if size >= 20 else size + max_missing
        self.min_density = min_density

    def possible(self, held: set) -> bool:
        return sum(self.times[w] for w in self.known & held) >= self.least

    def stretches(self, text: list) -> list[tuple[int, int]]:
        """Merged ranges that hold every span of text with enough known words."""
        hit = np.fromiter(map(self.known.__contains__, text), dtype="int32", count=len(text))
        total = np.concatenate([[0], np.cumsum(hit)])
        width = min(self.span, len(text))
        full = np.nonzero(total[width:] - total[:-width] >= self.least)[0]
        out: list[tuple[int, int]] = []
        for first in full.tolist():
            if out and first <= out[-1][1]:
                out[-1] = (out[-1][0], first + width)
            else:
                out.append((first, first + width))
        return out

    def matches(self, text: list) -> Iterator[tuple[float, int, int]]:
        """(coverage, first, end) of the template's matches."""
        found: list[list[tuple[int, int]]] = []
        todo = self.stretches(text)
        while todo:
            first, end = todo.pop()
            taken = self._apart(self._candidates(text, first, end))
            found += taken
            # what lies before, between and after the matches is aligned again
            edges = [first, *(at for pairs in taken for at in (pairs[0][0], pairs[-1][0] + 1)), end]
            if taken:
                todo += [(a, b) for a, b in zip(edges[::2], edges[1::2]) if b - a >= self.least]
        found.sort()
        for k, pairs in enumerate(found):
            # the words up to the neighbours may hold the rest of a notice that was cut by its window
            low = max(pairs[0][0] - self.span, found[k - 1][-1][0] + 1 if k else 0)
            stop = min(pairs[-1][0] + 1 + self.span, found[k + 1][0][0] if k + 1 < len(found) else len(text))
            whole = self._aligned(text, low, stop)
            if whole and len(whole) > len(pairs):
                found[k] = pairs = whole
            yield len(pairs) / len(self.words), pairs[0][0], pairs[-1][0] + 1

    def _starts(self, text: list, first: int, end: int) -> list[int]:
        """The place in each quarter span where most of the template's rarest words say that a notice begins."""
        rarest = min(self.times.values())
        places: dict[str, list[int]] = {}
        for k, word in enumerate(self.words):
            if self.times[word] == rarest:
                places.setdefault(word, []).append(k)
        votes = Counter(at - k for at in range(first, end) for k in places.get(text[at], ()))
        step = max(1, self.span // 4)
        best: dict[int, tuple[int, int]] = {}
        for at, n in votes.items():
            best[at // step] = max(best.get(at // step, (0, 0)), (n, -at))
        return sorted(-at for _, at in best.values())

    def _candidates(self, text: list, first: int, end: int) -> Iterator[list[tuple[int, int]]]:
        """Matches in windows of a stretch. A window that holds two whole notices has no
        unique word, so windows of less than two template lengths begin at likely starts."""
        size, step = len(self.words), max(1, self.span // 2)
        windows = {(at, at + 2 * self.span) for at in range(first, max(first + 1, end - step), step)}
        for at in self._starts(text, first, end):
            windows |= {(at, at + size), (at - size // 8, at + self.span + size // 8)}
        for low, stop in sorted({(max(low, first), min(stop, end)) for low, stop in windows}):
            if pairs := self._aligned(text, low, stop):
                yield pairs

    def _aligned(self, text: list, low: int, stop: int) -> list[tuple[int, int]] | None:
        """The template's match in a window, if it has enough words."""
        held = Counter(text[low:stop])
        if sum(min(n, held[w]) for w, n in self.times.items()) < self.least:
            return None
        pairs = self._dense([(low + at, k) for at, k in patience(text[low:stop], self.words)])
        return pairs if len(pairs) >= self.least else None

    @staticmethod
    def _apart(candidates: Iterator[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
        """Matches that don't overlap, in text order; those with most matched and fewest other words first."""
        taken: list[list[tuple[int, int]]] = []
        for pairs in sorted(candidates, key=lambda p: (p[-1][0] - p[0][0] + 1 - 2 * len(p), p[0][0])):
            at = bisect_left(taken, pairs)
            if (not at or taken[at - 1][-1][0] < pairs[0][0]) and (at == len(taken) or pairs[-1][0] < taken[at][0][0]):
                taken.insert(at, pairs)
        return taken

    def _dense(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Drop stray matches at the ends until the rest is dense enough."""
        while len(pairs) >= self.least and len(pairs) < self.min_density * (pairs[-1][0] - pairs[0][0] + 1):
            if pairs[1][0] - pairs[0][0] >= pairs[-1][0] - pairs[-2][0]:
                pairs = pairs[1:]
            else:
                pairs = pairs[:-1]
        return pairs


def scan(text: str | None, templates: list[Template]) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, first word, end word, matched template's length) of a text, in text order."""
    tokens = words.plain_words(text or "")
    held = set(tokens)
    found = []
    for template in templates:
        if template.possible(held):
            found += [(template.name, coverage, first, end, len(template.words)) for coverage, first, end in template.matches(tokens)]
    kept = [m for m in found if not any(o[1] * o[4] > m[1] * m[4] + 0.5 and o[2] <= m[2] and m[3] <= o[3] for o in found)]
    return sorted(kept, key=lambda m: (m[2], m[3], m[0]))


def scan_licenses(docs: DataFrame, licenses: dict[str, str], min_coverage: float = 0.8, min_density: float = 0.6, max_missing: int = 1) -> DataFrame:
    """One row per license match in a document (MATCH_SCHEMA)."""

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        templates = [Template(name, text, min_coverage, min_density, max_missing) for name, text in sorted(licenses.items())]
        for batch in tables.each(batches):
            rows = [(doc_id, *m) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in scan(text.as_py(), templates)]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
            names = ["doc_id", "license", "coverage", "first_word", "end_word", "n_words"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    tables.ship(docs.sparkSession)
    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return only.mapInArrow(matched, MATCH_SCHEMA)
