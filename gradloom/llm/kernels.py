"""Whole Arrow batches of texts as numpy arrays: bytes, words, lines, hashes and sums by row.

A word is a maximal run of bytes outside of space, tab, LF, VT, FF and CR. These six are single bytes in UTF-8, so
words can be cut on bytes. Nulls read as empty texts. Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes handled at once; a single longer text is handled alone. Bounds a task's memory to a few dozen times this.
SLICE_BYTES = 1024 * 1024

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(z: np.ndarray) -> np.ndarray:
    """The published splitmix64 finaliser on whole arrays."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def sequence(start: int, n: int) -> np.ndarray:
    """The n values of a splitmix64 stream from place ``start`` on."""
    with np.errstate(over="ignore"):
        return mix(np.arange(start + 1, start + n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


BYTE_CODES = sequence(0, 256)
LOWER_CODES = BYTE_CODES[LOWER]
PLACE_CODES = sequence(1 << 20, 4096) | np.uint64(1)
WINDOW_CODES = sequence(1 << 32, 64) | np.uint64(1)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows so that each part holds at most ``limit`` text bytes, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, low = np.cumsum(lengths, dtype=np.int64), 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = max(int(np.searchsorted(ends, before + limit, side="right")), low + 1)
        yield batch.slice(low, high - low)
        low = high


class Texts:
    """The texts of a batch column: ``data`` (bytes of all rows, one after another) and ``offsets`` (rows + 1)."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
        _, ends, data = column.buffers()
        offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.rows = len(column)

    def sums(self, flags: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        """How many ``flags`` (one per byte) hold between consecutive bounds; by default in each row."""
        return segment_sums(flags, self.offsets if bounds is None else bounds)


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]; 0 for empty segments."""
    out = np.zeros(len(bounds) - 1, dtype=np.int64)
    filled = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(filled):
        out[filled] = np.add.reduceat(values, bounds[:-1][filled], dtype=np.int64)
    return out


class Words:
    """Where the words of ``texts`` start and end; words ``bounds[i]:bounds[i + 1]`` are those of row i.

    ``is_word`` says which bytes are inside of words.
    """

    def __init__(self, texts: Texts, is_word: np.ndarray = IS_WORD):
        inside = is_word[texts.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = texts.offsets[1:] > texts.offsets[:-1]
        heads, tails = texts.offsets[:-1][filled], texts.offsets[1:][filled] - 1
        first[heads], last[tails] = inside[heads], inside[tails]
        self.texts, self.inside = texts, inside
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, texts.offsets)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts.rows), np.diff(self.bounds))

    def hashes(self, lower: bool, seed: int = 0) -> np.ndarray:
        """One hash per word, of its bytes (A-Z as a-z if ``lower``); another ``seed`` tells other words apart."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        heads = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
        longest = int(lengths.max())
        ready = not seed and longest <= len(PLACE_CODES)
        codes = PLACE_CODES if ready else sequence((1 << 20) + (seed << 40), longest) | np.uint64(1)
        with np.errstate(over="ignore"):
            spread = (LOWER_CODES if lower else BYTE_CODES)[self.texts.data[self.inside]] * codes[place]
            return mix(np.add.reduceat(spread, heads) + lengths.astype(np.uint64))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive values; row borders are the caller's concern."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = values[:n] * WINDOW_CODES[0]
        for k in range(1, width):
            total = total + values[k : n + k] * WINDOW_CODES[k]
    return mix(total)


def windows_inside(bounds: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n window starts keep all their ``width`` words in one row."""
    good = np.zeros(max(n, 0), dtype=bool)
    counts = np.diff(bounds)
    full = counts >= width
    edges = np.zeros(max(n, 0) + 1, dtype=np.int64)
    np.add.at(edges, bounds[:-1][full], 1)
    np.add.at(edges, (bounds[1:] - width + 1)[full], -1)
    good[:] = np.cumsum(edges)[: max(n, 0)] > 0
    return good


def local_ranks(groups: np.ndarray, seen: dict[int, int]) -> np.ndarray:
    """Rank of every row inside its group in the order of arrival; ``seen`` counts what came before and is updated."""
    if not len(groups):
        return np.zeros(0, np.int64)
    order = np.argsort(groups, kind="stable")
    held = groups[order]
    heads = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    sizes = np.diff(np.concatenate([heads, [len(held)]]))
    names = held[heads].tolist()
    base = np.array([seen.get(g, 0) for g in names], dtype=np.int64)
    ranks = np.empty(len(groups), np.int64)
    ranks[order] = np.arange(len(groups)) - np.repeat(heads, sizes) + np.repeat(base, sizes)
    for g, b, s in zip(names, base.tolist(), sizes.tolist()):
        seen[g] = b + s
    return ranks
