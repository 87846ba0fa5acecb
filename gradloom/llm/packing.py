"""Packing: documents as token sequences of one length, by shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

import base64
import functools
import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.llm.batches import map_arrow
from gradloom.llm.kernels import slices
from gradloom.llm.numbering import number_placed
from gradloom.session import reliable_checkpoint

SEQUENCE_TOKENS = 1024
# Closes every document.
END_ID = 0
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
# Below this code point both libraries cut texts alike (a test tries every one); other texts take the slower one.
PLAIN_LIMIT = 0x250
# Longest run without white space that goes to the faster library.
RUN_LIMIT = 2_000


@functools.lru_cache(maxsize=1)
def plain_encoder():
    """The vocabulary in ``tokenizers``, which defines the ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


@functools.lru_cache(maxsize=1)
def fast_encoder():
    """The same vocabulary in ``tiktoken``, which is faster."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD_CHARACTER = re.compile(f"[^\\x00-\\u{PLAIN_LIMIT - 1:04x}]")
LONG_RUN = re.compile(rf"\S{{{RUN_LIMIT}}}")


@functools.lru_cache(maxsize=1)
def added_tokens() -> tuple[str, ...]:
    """Tokens that the vocabulary finds in a text before it is cut, such as <|endoftext|>."""
    import public_tokenizers

    with open(public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return tuple(t["content"] for t in json.load(file)["added_tokens"])


def is_plain(text: str) -> bool:
    """Whether the faster library, which knows no added tokens, gives the same ids, and in good time."""
    if any(token in text for token in added_tokens()):
        return False
    return ODD_CHARACTER.search(text) is None and LONG_RUN.search(text) is None


def token_ids(text: str) -> np.ndarray:
    """Ids of a text as unsigned 32-bit numbers, without the closing one."""
    if is_plain(text):
        ids = fast_encoder().encode_ordinary(text)
    else:
        ids = plain_encoder().encode(text, add_special_tokens=False).ids
    return np.array(ids, dtype="<u4")


def cut_documents(documents: DataFrame, limit: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, ids (little-endian unsigned 32-bit), doc_tokens.

    A document is its ids and then ``END_ID``, cut every ``limit`` ids; a null text is the closing id alone. Texts are read
    whole; rows repeat as they do in the table.
    """

    def cut(batches):
        for whole in batches:
            for batch in slices(whole.select(["doc_id", "text"])):
                at, starts, pieces, totals = [], [], [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    ids = np.append(token_ids(text or ""), np.uint32(END_ID)).astype("<u4").tobytes()
                    for start in range(0, len(ids), 4 * limit):
                        at.append(i)
                        starts.append(start // 4)
                        pieces.append(ids[start : start + 4 * limit])
                        totals.append(len(ids) // 4)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(starts, pa.int64()), pa.array(pieces, pa.binary()), pa.array(totals, pa.int64())],
                    names=["doc_id", "start", "ids", "doc_tokens"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_arrow(documents.select("doc_id", "text"), cut, f"doc_id {kind}, start bigint, ids binary, doc_tokens bigint")


def shortest_pack_first(histogram: dict[int, int], limit: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in the order they were placed) and how many packs follow each.

    Lengths are placed longest first, always on the shortest pack there is, for all packs of one pattern at once. Where the
    length does not fit on the shortest pack it fits on none, and packs are opened, each for as many pieces of this length
    as it holds: the next piece goes on the pack just opened, which is then the shortest. The work follows the number of
    distinct lengths, not of documents.
    """
    counts: list[int] = []
    patterns: list[list[int]] = []
    heap: list[tuple[int, int]] = []

    def put(pattern: list[int], total: int, count: int) -> None:
        patterns.append(pattern)
        counts.append(count)
        heapq.heappush(heap, (total, len(patterns) - 1))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or heap[0][0] + length > limit:
                each = limit // length
                if left >= each:
                    put([length] * each, length * each, left // each)
                if left % each:
                    put([length] * (left % each), length * (left % each), 1)
                break
            total, shortest = heapq.heappop(heap)
            taken = min(left, counts[shortest])
            if taken < counts[shortest]:
                put(patterns[shortest].copy(), total, counts[shortest] - taken)
                counts[shortest] = taken
            patterns[shortest].append(length)
            heapq.heappush(heap, (total + length, shortest))
            left -= taken
    return list(zip(patterns, counts))


class Slots:
    """For every length its ranks in runs: where a run begins, its first sequence and its offset there."""

    def __init__(self, patterns: list[tuple[list[int], int]]):
        runs: dict[int, list[tuple[int, int, int]]] = {}
        used: dict[int, int] = {}
        self.sequences = 0
        for lengths, count in patterns:
            offset = 0
            for length in lengths:
                rank = used.get(length, 0)
                runs.setdefault(length, []).append((rank, self.sequences, offset))
                used[length] = rank + count
                offset += length
            self.sequences += count
        self.runs = {length: np.array(rows, dtype=np.int64).T for length, rows in runs.items()}

    def place(self, lengths: np.ndarray, ranks: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece; full pieces come after all packs, one sequence each."""
        sequence, offset = self.sequences + ranks, np.zeros(len(ranks), np.int64)
        for length in np.unique(lengths[lengths < limit]).tolist():
            rows = np.flatnonzero(lengths == length)
            starts, first, inside = self.runs[length]
            run = np.searchsorted(starts, ranks[rows], side="right") - 1
            sequence[rows] = first[run] + ranks[rows] - starts[run]
            offset[rows] = inside[run]
        return sequence, offset


def pack_pieces(pieces: DataFrame, length: str = "length", limit: int = SEQUENCE_TOKENS) -> DataFrame:
    """Add sequence_id and offset to every piece; all other columns are kept, columns of these two names replaced.

    Only the histogram (at most ``limit`` rows) reaches the driver, and what tasks get back is a list of runs whose size
    follows the number of distinct lengths. Pieces are numbered inside their length where they lie, so a length
    that a third of all pieces share stays spread. Lengths run from 1 to ``limit``; null or other ones raise. An empty table
    stays empty; repeated rows are pieces of their own.
    """
    rows = pieces.drop("sequence_id", "offset", "_group")
    checked = F.when(F.col(length).between(1, limit), F.col(length)).otherwise(
        F.raise_error(F.lit(f"piece lengths must lie in 1..{limit}"))
    )
    placed = reliable_checkpoint(rows.withColumn("_group", checked.cast("bigint")))
    histogram = {r["_group"]: r["count"] for r in placed.groupBy("_group").count().collect()}
    slots = Slots(shortest_pack_first({k: n for k, n in histogram.items() if k < limit}, limit))
    ranked = number_placed(placed, "_group", "_rank")
    kept = ranked.drop("_group", "_rank")
    group, rank = ranked.columns.index("_group"), ranked.columns.index("_rank")
    names = [*kept.columns, "sequence_id", "offset"]

    def assign(batches):
        for batch in batches:
            found = slots.place(
                batch.column(group).to_numpy(zero_copy_only=False), batch.column(rank).to_numpy(zero_copy_only=False), limit
            )
            held = [c for i, c in enumerate(batch.columns) if i not in (group, rank)]
            yield pa.RecordBatch.from_arrays([*held, *map(pa.array, found)], names=names)

    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return map_arrow(ranked, assign, T.StructType([*kept.schema.fields, *added]))


def packed_documents(documents: DataFrame, limit: int = SEQUENCE_TOKENS) -> DataFrame:
    """The pieces of all documents with digests of their ids, their sequence and their offset in it."""
    pieces = cut_documents(documents, limit).select(
        "doc_id", "start", (F.length("ids") / 4).cast("bigint").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack_pieces(pieces, "length", limit)
