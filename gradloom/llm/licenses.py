"""License scans: patience alignment of license notices and whole license texts with the words of a text."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame

from gradloom.llm import license_texts
from gradloom.llm.batches import map_arrow
from gradloom.llm.kernels import Texts, slices

# Notices as their licenses tell users to write them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# Whole texts of licenses; in the table they are called "… text".
TEXTS = {f"{name} text": text for name, text in license_texts.TEXTS.items()}
TEMPLATES = NOTICES | TEXTS
# Notices of more words are long ones: what a good alignment holds already is not taken as a place of its own.
LONG_WORDS = 60
# Share of a notice's words that must be aligned.
LEAST_COVERAGE = 0.8
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
EDGE = re.compile(rb"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$")


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z lowered and ASCII punctuation cut off at both ends; words of nothing else are left out."""
    return [w for w in (EDGE.sub(b"", m) for m in WORD.findall(text.lower())) if w]


def align(text: list[bytes], low: int, high: int, notice: list[bytes], first: int, last: int) -> list[tuple[int, int]]:
    """Aligned places (in text, in notice) of text[low:high] with notice[first:last], both growing.

    Equal words at both ends are aligned; then words that stand once in either part are anchors, their longest increasing
    run is kept, and the gaps between anchors are aligned in turn. A gap without anchors ends there.
    """
    out, todo = [], [(low, high, first, last)]
    while todo:
        low, high, first, last = todo.pop()
        while low < high and first < last and text[low] == notice[first]:
            out.append((low, first))
            low, first = low + 1, first + 1
        while low < high and first < last and text[high - 1] == notice[last - 1]:
            high, last = high - 1, last - 1
            out.append((high, last))
        if low == high or first == last:
            continue
        once = {w for w, n in Counter(notice[first:last]).items() if n == 1}
        seen = Counter(w for w in text[low:high] if w in once)
        place = {w: i for i, w in enumerate(notice[first:last], first) if seen.get(w) == 1}
        anchors = _increasing([(i, place[w]) for i, w in enumerate(text[low:high], low) if w in place])
        if not anchors:
            continue
        at, spot = low, first
        for i, j in anchors:
            out.append((i, j))
            todo.append((at, i, spot, j))
            at, spot = i + 1, j + 1
        todo.append((at, high, spot, last))
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs whose second parts grow, by patience sorting; first parts grow already."""
    tops: list[int] = []
    held: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        before[n] = held[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(j)
            held.append(n)
        else:
            tops[pile], held[pile] = j, n
    out, n = [], held[-1] if held else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _span(pairs: list[tuple[int, int]]) -> int:
    return pairs[-1][0] + 1 - pairs[0][0]


def common_words(text: list[bytes], low: int, high: int, marks: dict[bytes, int], size: int) -> int:
    """The most words that text[low:high] and a notice of ``size`` words share in order (their longest common subsequence).

    ``marks`` has a bit per place of a word in the notice; a zero bit of ``rest`` is a step of the common run, so a word of the
    text costs a few operations on whole numbers of ``size`` bits.
    """
    full = rest = (1 << size) - 1
    for word in text[low:high]:
        met = rest & marks.get(word, 0)
        if met:
            rest = ((rest + met) | (rest - met)) & full
    return size - rest.bit_count()


class Notice:
    """A notice ready for scanning."""

    def __init__(self, name: str, text: str, least: float):
        self.name, self.words = name, words_of(text.encode())
        self.counts = Counter(self.words)
        # An alignment that covers enough lacks fewer words than this.
        self.spare = len(self.words) - least * len(self.words)
        self.needed = least * len(self.words)
        self.spots: dict[bytes, list[int]] = {}
        for spot, word in enumerate(self.words):
            self.spots.setdefault(word, []).append(spot)
        fewest = sorted(map(len, self.words))[: math.ceil(self.needed - 1e-9)]
        self.least_bytes = sum(fewest) + len(fewest) - 1
        self.longest_first = sorted(self.counts, key=lambda w: (-len(w), w))

    @cached_property
    def marks(self) -> dict[bytes, int]:
        return {word: sum(1 << spot for spot in spots) for word, spots in self.spots.items()}

    def may_stand_in(self, lowered: bytes) -> bool:
        """Whether enough of the words occur as byte runs, in a look that ends early for nearly all texts."""
        if len(lowered) < self.least_bytes:
            return False
        lacking = 0
        for word in self.longest_first:
            if word not in lowered:
                lacking += self.counts[word]
                if lacking > self.spare:
                    return False
        return True

    def best(self, text: list[bytes], places: dict[bytes, list[int]]) -> list[tuple[int, int]]:
        """The alignment with the most words, of those the tightest and then the first; none if too few words are at hand.

        Windows around every place of the notice's words are aligned, for a long notice around those of its rarest words: so
        many that an alignment that covers enough holds one of them. Each place is also taken as fixed, for every spot of its
        word in the notice, and the words before and behind it are aligned up to the places where the word stands in
        the next copies: copies that follow each other closely do not take each other's anchors. Windows that hold fewer
        words of the notice than needed, or than found already, are not aligned, nor are those in stretches of text that share
        fewer with it in order (``common_words``), which no alignment exceeds: words of a license in other order cost a
        pass over each stretch. A long notice is taken at words that stand in it once, and places inside an alignment that
        covers enough are not tried again.
        """
        if sum(min(n, len(places.get(w, ()))) for w, n in self.counts.items()) < self.needed:
            return []
        size = len(self.words)
        long, tried, mass = size > LONG_WORDS, [], 0
        for word in sorted(self.counts, key=lambda w: (len(places.get(w, ())), w)):
            tried += [(at, n, word) for n, at in enumerate(places.get(word, ()))]
            mass += self.counts[word]
            if long and mass > self.spare:
                break
        found: list[tuple[int, int]] = []
        held, begin, end, mass = Counter(), 0, 0, 0
        done, step, most = set(), 2 * size, {}
        for at, n, word in sorted(tried):
            low, high = max(0, at - 2 * size), min(len(text), at + 2 * size + 1)
            for w in text[end:high]:
                if w in self.counts:
                    mass += held[w] < self.counts[w]
                    held[w] += 1
            for w in text[begin:low]:
                if w in self.counts:
                    held[w] -= 1
                    mass -= held[w] < self.counts[w]
            begin, end = low, high
            if mass < self.needed or mass < len(found) or at in done:
                continue
            stretch = low // step  # three steps long, so that it holds the window
            if stretch not in most:
                most[stretch] = common_words(text, stretch * step, (stretch + 3) * step + 1, self.marks, size)
            if most[stretch] < self.needed or most[stretch] < len(found):
                continue
            tries = [align(text, low, high, self.words, 0, size)]
            spots, same = self.spots[word], places[word]
            if long and len(spots) > 1:
                spots = []
            for k, spot in enumerate(spots):
                before, behind = n - k - 1, n - k + len(spots)
                first = max(low, same[before] + 1) if before >= 0 else low
                last = min(high, same[behind]) if behind < len(same) else high
                head = align(text, first, at, self.words, 0, spot)
                tries.append([*head, (at, spot), *align(text, at + 1, last, self.words, spot + 1, size)])
            for got in tries:
                if got and (not found or (-len(got), _span(got)) < (-len(found), _span(found))):
                    found = got
                if long and len(got) >= self.needed:
                    done.update(i for i, _ in got)
            if found and len(found) == _span(found) == size:
                break
        return found


def scan_licenses(documents: DataFrame, notices: dict[str, str] | None = None, least: float = LEAST_COVERAGE) -> DataFrame:
    """doc_id, license, coverage, start_word, end_word for every notice that a text covers by ``least`` or more.

    Coverage is the aligned share of a notice's words in its best place; places count the words of ``words_of``, the end
    exclusive. A text may hold several licenses. Whole texts are read; null and empty ones give no rows, repeated rows
    give theirs again. The list of notices is the caller's and goes to every task.
    """
    book = [Notice(name, text, least) for name, text in sorted((TEMPLATES if notices is None else notices).items())]

    def scan(batches):
        for whole in batches:
            for batch in slices(whole):
                texts = Texts(batch.column("text"))
                raw, ends = texts.data.tobytes().lower(), texts.offsets.tolist()
                at, rows = [], []
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    lowered = raw[a:b]
                    some = [n for n in book if n.may_stand_in(lowered)]
                    if not some:
                        continue
                    words = words_of(lowered)
                    wanted = set().union(*(n.counts for n in some))
                    places: dict[bytes, list[int]] = {}
                    for place, word in enumerate(words):
                        if word in wanted:
                            places.setdefault(word, []).append(place)
                    for notice in some:
                        found = notice.best(words, places)
                        if found and len(found) >= notice.needed:
                            at.append(i)
                            rows.append((notice.name, len(found) / len(notice.words), found[0][0], found[-1][0] + 1))
                columns = list(zip(*rows)) if rows else [[], [], [], []]
                kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    names=["doc_id", "license", "coverage", "start_word", "end_word"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        documents.select("doc_id", "text"), scan, f"doc_id {kind}, license string, coverage double, start_word bigint, end_word bigint"
    )
