"""Phrase collocations from suffix subtrees: vertical partitions of word prefixes, built and counted one by one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradloom.llm.batches import map_arrow
from gradloom.llm.kernels import LOWER, Texts, Words, mix, sequence, slices
from gradloom.session import BROADCAST_BYTES, attach, reliable_checkpoint, scratch_path

LONGEST = 4
LEAST = 30
COVER_PERCENT = 80
TOP = 2000
NO_LANGUAGE = "und"
# Occurrences whose suffixes one subtree may hold: the memory budget of a partition, some 32 bytes each.
BUDGET = 1 << 21
# Suffixes a map task holds before it sorts them, adds up equal ones and cuts them into blocks.
HELD_SUFFIXES = 1 << 21

IS_WORD = np.ones(256, dtype=bool)
IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[[46, 44, 59, 58, 33, 63, 10, 11, 12, 13]] = True  # . , ; : ! ? LF VT FF CR
IS_WORD[IS_BREAK] = False
IS_WORD[[32, 9]] = False
CODEC = pa.Codec("zstd", compression_level=1)


class Pieces:
    """The words of a batch of texts, which of them follow the one before in the same piece, and a hash of each with its language."""

    def __init__(self, batch: pa.RecordBatch, seed: int):
        texts = Texts(batch.column("text"))
        self.words = Words(texts, IS_WORD)
        breaks = np.cumsum(IS_BREAK[texts.data]) if len(texts.data) else np.zeros(0, np.int64)
        starts, row = self.words.starts, self.words.row_of()
        piece = breaks[starts]
        self.follows = np.zeros(len(starts), bool)
        self.follows[1:] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
        self.row = row
        names = batch.column("lang").dictionary_encode()
        tags = np.array([_name_code(str(name)) for name in names.dictionary.to_pylist()], np.uint64)
        tag = tags[names.indices.to_numpy(zero_copy_only=False)] if len(tags) else np.zeros(0, np.uint64)
        hashes = self.words.hashes(lower=True, seed=seed)
        self.hashes = mix(hashes ^ tag[row]) | np.uint64(1)  # never 0, which ends a suffix

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The lower-cased words at these places."""
        data, starts, ends = self.words.texts.data, self.words.starts, self.words.ends
        return pa.array([LOWER[data[starts[i] : ends[i]]].tobytes().decode() for i in at.tolist()], pa.string())


def _name_code(name: str) -> np.uint64:
    value = np.uint64(0)
    for byte in name.encode():
        value = mix(np.array([value]) + sequence(1 << 48, 1) * np.uint64(byte + 1))[0]
    return value


class Coder:
    """Codes of words: places in the list of frequent words while that list may be shipped, else their hashes.

    With a list, words that are not on it have code 0 and end a suffix: no phrase that counts runs across them.
    """

    def __init__(self, seed: int, frequent: np.ndarray | None):
        self.seed, self.frequent = seed, frequent
        self.kind = np.dtype(np.uint64 if frequent is None else np.uint32)
        # Bits of a place inside a shard: some ten thousand listed words, or a 256th of all hashes.
        self.shard_bits = 56 if frequent is None else 14

    def code(self, place: int) -> int:
        """From a place, a signed number in the order of codes."""
        return place + 2**63 if self.frequent is None else place

    def places(self, codes: np.ndarray) -> np.ndarray:
        codes = codes.astype(np.uint64)
        return (codes ^ np.uint64(1 << 63)).view(np.int64) if self.frequent is None else codes.astype(np.int64)

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        if self.frequent is None:
            return hashes
        if not len(self.frequent):
            return np.zeros(len(hashes), self.kind)
        at = np.searchsorted(self.frequent, hashes)
        known = self.frequent[np.minimum(at, len(self.frequent) - 1)] == hashes
        return np.where(known, at + 1, 0).astype(self.kind)

    def suffixes(self, pieces: Pieces) -> np.ndarray:
        """``LONGEST`` codes from every word on that has a second one behind it, cut at ends of pieces and at code 0."""
        codes = self.codes(pieces.hashes)
        table = np.zeros((len(codes), LONGEST), self.kind)
        table[:, 0] = codes
        going = codes != 0
        for k in range(1, min(LONGEST, len(codes))):
            ahead = np.zeros(len(codes), bool)
            ahead[: len(codes) - k] = pieces.follows[k:]
            going = going & ahead
            going[: len(codes) - k] &= codes[k:] != 0
            table[: len(codes) - k, k] = np.where(going[: len(codes) - k], codes[k:], 0)
        return table[table[:, 1] != 0]


def in_order(table: np.ndarray) -> np.ndarray:
    """Places of the suffixes in the order of their codes."""
    if table.dtype == np.uint32:  # two codes are one number
        table = table.astype(np.uint64)
        table = (table[:, ::2] << np.uint64(32)) | table[:, 1::2]
    return np.lexsort(table.T[::-1])


def merged(table: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes in order with the sums of their counts: the leaves of a subtree."""
    order = in_order(table)
    table, counts = table[order], counts[order]
    heads = np.flatnonzero(np.r_[True, (table[1:] != table[:-1]).any(axis=1)]) if len(table) else np.zeros(0, np.int64)
    return table[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def subtree(table: np.ndarray, counts: np.ndarray, least: int, low: np.ndarray | None, high: np.ndarray | None):
    """The nodes of depth 2 to ``LONGEST``: (codes, leaf total) of those with ``least`` or more, read from sorted leaves.

    Nodes on the way to the partition's first suffix (``low``) or to that behind its last one (``high``) may go on in a
    neighbour and come out whatever their total.
    """
    for depth in range(2, LONGEST + 1):
        deep = table[:, depth - 1] != 0
        rows, held = table[deep][:, :depth], counts[deep]
        if not len(rows):
            continue
        heads = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
        totals, rows = np.add.reduceat(held, heads), rows[heads]
        wanted = totals >= least
        for edge in (low, high):
            if edge is not None:
                wanted |= (rows == edge[:depth]).all(axis=1)
        node = np.zeros((int(wanted.sum()), LONGEST), table.dtype)
        node[:, :depth] = rows[wanted]
        yield node, totals[wanted]


def _places(table: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where in the sorted suffixes each of the sorted ``edges`` belongs."""
    low, high = np.zeros(len(edges), np.int64), np.full(len(edges), len(table))
    for i, edge in enumerate(edges):
        a, b = 0, len(table)
        for k in range(LONGEST):
            column = table[a:b, k]
            a, b = a + np.searchsorted(column, edge[k], "left"), a + np.searchsorted(column, edge[k], "right")
        low[i], high[i] = a, b
    return low


def _packed(table: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted suffixes column by column, so that what repeats takes next to nothing."""
    raw = np.ascontiguousarray(table.T).tobytes() + counts.astype(np.int64).tobytes()
    return CODEC.compress(raw, asbytes=True)


def _unpacked(block: bytes, rows: int, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    size = rows * LONGEST * kind.itemsize
    raw = CODEC.decompress(block, size + 8 * rows, asbytes=True)
    return np.frombuffer(raw[:size], kind).reshape(LONGEST, rows).T, np.frombuffer(raw[size:], np.int64)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.where("text IS NOT NULL").select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")


def count_words(documents: DataFrame, seed: int) -> DataFrame:
    """lang, word, code (hash) and f of every word."""

    def count(batches):
        for whole in batches:
            for batch in slices(whole):
                pieces = Pieces(batch, seed)
                found, first, n = np.unique(pieces.hashes, return_index=True, return_counts=True)
                lang = batch.column("lang").take(pa.array(pieces.row[first])) if len(first) else pa.array([], pa.string())
                yield pa.RecordBatch.from_pydict(
                    {"lang": lang, "word": pieces.spelled(first), "code": found.view(np.int64), "f": n}
                )

    words = map_arrow(_texts(documents), count, "lang string, word string, code bigint, f bigint")
    return words.groupBy("lang", "word", "code").agg(F.sum("f").alias("f"))


def _suffix_batches(batches, coder: Coder) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct suffixes with counts, ``HELD_SUFFIXES`` at a time."""
    held, size = [], 0
    for whole in batches:
        for batch in slices(whole):
            table = coder.suffixes(Pieces(batch, coder.seed))
            held.append(table)
            size += len(table)
            if size >= HELD_SUFFIXES:
                table = np.concatenate(held)
                yield merged(table, np.ones(len(table), np.int64))
                held, size = [], 0
    if size:
        table = np.concatenate(held)
        yield merged(table, np.ones(len(table), np.int64))


def partition_edges(documents: DataFrame, first: DataFrame, coder: Coder, budget: int) -> np.ndarray:
    """First suffixes of the partitions, in order; each partition but a single suffix's holds ``budget`` occurrences at most.

    Vertical partitioning: neighbouring one-word prefixes (``first``: place and f) are grouped up to the budget; a prefix
    beyond it is alone and is extended by a word, its extensions counted and grouped in the same way, up to whole
    suffixes. Only edges come to the driver, one per half budget of occurrences and one per shard of a prefix.
    """
    edges, heavy = _grouped(first.select(F.lit(0).alias("prefix"), "place", "f"), coder, budget)
    table = [[coder.code(e["place"])] for e in edges]
    prefixes = [[coder.code(e["place"])] for e in heavy]
    while prefixes and len(prefixes[0]) < LONGEST:
        edges, heavy = _grouped(_extensions(documents, coder, prefixes), coder, budget)
        table += [prefixes[e["prefix"]] + [coder.code(e["place"])] for e in edges]
        prefixes = [prefixes[e["prefix"]] + [coder.code(e["place"])] for e in heavy]
    whole = {tuple(e + [0] * (LONGEST - len(e))) for e in [*table, [0]]}
    return np.array(sorted(whole), coder.kind).reshape(-1, LONGEST)


def _grouped(counts: DataFrame, coder: Coder, budget: int) -> tuple[list, list]:
    """From (prefix, place, f): the places where a new group begins, and those that exceed the budget alone.

    A window per shard of a prefix runs over one row per distinct next word. A new group begins wherever the running
    sum enters another half budget, so that a group holds a whole one at most.
    """
    half = max(budget // 2, 1)
    heavy = F.col("f") > half
    step = W.partitionBy("prefix", F.shiftright("place", coder.shard_bits)).orderBy("place")
    before = step.rowsBetween(W.unboundedPreceding, -1)
    running = F.floor(F.coalesce(F.sum("f").over(before), F.lit(0)) / half)
    marked = counts.withColumn("group", running).withColumn("heavy", heavy)
    opens = (F.col("group") != F.lag("group", 1, -1).over(step)) | F.col("heavy") | F.lag("heavy", 1, False).over(step)
    found = marked.withColumn("opens", opens).where("opens").select("prefix", "place", "f").collect()
    return found, [r for r in found if r["f"] > budget]


def _extensions(documents: DataFrame, coder: Coder, prefixes: list[list[int]]) -> DataFrame:
    """(prefix, place, f): how often each next word follows each of these prefixes."""
    depth = len(prefixes[0])
    shipped = documents.sparkSession.sparkContext.broadcast((coder, np.array(prefixes, coder.kind)))

    def count(batches):
        held, wanted = shipped.value
        for table, counts in _suffix_batches(batches, held):
            for number, prefix in enumerate(wanted):
                low = _places(table, np.r_[prefix, np.zeros(LONGEST - depth, held.kind)][None, :])[0]
                same = table[low:]
                for k in range(depth):  # sorted: what begins alike stands together
                    same = same[: np.searchsorted(same[:, k], prefix[k], "right")]
                n = counts[low : low + len(same)]
                n, same = n[same[:, depth] != 0], same[same[:, depth] != 0]
                following = same[:, depth]
                heads = np.flatnonzero(np.r_[True, following[1:] != following[:-1]]) if len(same) else np.zeros(0, np.int64)
                if not len(heads):
                    continue
                yield pa.RecordBatch.from_pydict({
                    "prefix": np.full(len(heads), number, np.int32), "place": held.places(following[heads]), "f": np.add.reduceat(n, heads),
                })

    found = map_arrow(_texts(documents), count, "prefix int, place bigint, f bigint")
    return found.groupBy("prefix", "place").agg(F.sum("f").alias("f"))


def count_phrases(documents: DataFrame, coder: Coder, edges: np.ndarray, least: int) -> DataFrame:
    """w0 .. w3 (codes, 0 behind the phrase's end) and f of every phrase of 2 to ``LONGEST`` words that occurs ``least`` times.

    Tasks sort the suffixes of their texts, add up equal ones and send one compressed block per partition; a partition's
    blocks meet in one task, which merges them into the leaves of its subtree and reads the counts of all its nodes.
    """
    spark = documents.sparkSession
    attach(spark)
    shipped = spark.sparkContext.broadcast((coder, edges))

    def cut(batches):
        held, firsts = shipped.value
        for table, counts in _suffix_batches(batches, held):
            at = np.r_[_places(table, firsts), len(table)]
            filled = np.flatnonzero(at[1:] > at[:-1])
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(filled.astype(np.int32)), "rows": at[filled + 1] - at[filled],
                "block": pa.array([_packed(table[at[i] : at[i + 1]], counts[at[i] : at[i + 1]]) for i in filled], pa.binary()),
            })

    names = [f"w{k}" for k in range(LONGEST)]
    shape = ", ".join(f"{name} bigint" for name in names) + ", f bigint"

    def build(blocks: pa.Table) -> pa.Table:
        held, firsts = shipped.value
        part = blocks.column("part")[0].as_py()
        table, counts = np.zeros((0, LONGEST), held.kind), np.zeros(0, np.int64)
        waiting, size = [], 0
        sizes, column = blocks.column("rows").to_pylist(), blocks.column("block")
        for i, rows in enumerate(sizes):
            waiting.append(_unpacked(column[i].as_py(), rows, held.kind))
            size += rows
            if size >= BUDGET or i == len(sizes) - 1:  # equal suffixes of many tasks never pile up
                table, counts = merged(np.concatenate([table, *(t for t, _ in waiting)]), np.concatenate([counts, *(c for _, c in waiting)]))
                waiting, size = [], 0
        low, high = firsts[part], firsts[part + 1] if part + 1 < len(firsts) else None
        found = list(subtree(table, counts, least, low, high))
        nodes = np.concatenate([np.zeros((0, LONGEST), held.kind), *(n for n, _ in found)]).astype(np.uint64).view(np.int64)
        totals = np.concatenate([np.zeros(0, np.int64), *(t for _, t in found)])
        return pa.table({**{name: nodes[:, k] for k, name in enumerate(names)}, "f": totals})

    blocks = map_arrow(_texts(documents), cut, "part int, rows bigint, block binary")
    nodes = blocks.groupBy("part").applyInArrow(build, shape)
    return nodes.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases.

    A-Z are lower-cased; texts are cut at . , ; : ! ? and line breaks into pieces, these at spaces and tabs into words. A
    phrase is 2 to 4 words inside a piece with a = f(phrase) >= ``least``. Cut behind its first k words, with l and r
    occurrences of both parts, it scores floor(2000000 a / (l + r)); the lowest score counts, of equal ones the smallest k. Phrases inside a
    longer one that keeps 80 of 100 of their occurrences go. n is the number of words of the language. Order: score and a from
    the largest, then the phrase by its bytes. All counts are of whole texts; arithmetic is decimal where it may pass 64 bits.

    Counts of words come from one aggregate. All longer phrases are nodes of suffix subtrees, cut off at four words and
    built per partition of prefixes (``partition_edges``). Null texts are empty, null languages ``und``; repeated
    rows count as often as they stand; wordless and empty tables give no rows; other columns are not looked at.
    """
    spark = documents.sparkSession
    path, seed = scratch_path(spark, "phrases"), 0
    while True:
        count_words(documents, seed).write.parquet(f"{path}/words-{seed}")
        words = spark.read.parquet(f"{path}/words-{seed}")
        if not words.groupBy("code").count().where("count > 1").head(1):
            break
        seed += 1  # two words of one hash: other hashes tell them apart
    frequent = words.where(F.col("f") >= least)
    listed = None
    if frequent.count() * 16 <= BROADCAST_BYTES:
        listed = np.sort(frequent.select("code").toArrow().column("code").to_numpy().view(np.uint64))
    coder = Coder(seed, listed)
    named = reliable_checkpoint(_coded(frequent, coder))
    first = named if listed is not None else _coded(words, coder)
    edges = partition_edges(documents, first, coder, budget)
    nodes = reliable_checkpoint(count_phrases(documents, coder, edges, least))
    return _ranked(nodes, named, words, top)


def _coded(words: DataFrame, coder: Coder) -> DataFrame:
    """lang, word, f, code (as in suffixes) and place of words."""
    shipped = words.sparkSession.sparkContext.broadcast(coder)

    def run(batches):
        held = shipped.value
        for batch in batches:
            codes = held.codes(batch.column("code").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("lang", "word", "f")), pa.array(codes.astype(np.uint64).view(np.int64)), pa.array(held.places(codes))],
                names=["lang", "word", "f", "code", "place"],
            )

    return map_arrow(words, run, "lang string, word string, f bigint, code bigint, place bigint")


def _ranked(nodes: DataFrame, named: DataFrame, words: DataFrame, top: int) -> DataFrame:
    codes = [f"w{k}" for k in range(LONGEST)]
    phrases = nodes.select(F.filter(F.array(*codes), lambda c: c != 0).alias("key"), "f")
    single = named.select(F.array("code").alias("key"), "f")
    known = phrases.unionByName(single)
    size = F.size("key")
    cuts = phrases.select("key", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.slice("key", F.lit(1), F.col("k"))).withColumn("tail", F.slice("key", F.col("k") + 1, size))
    cuts = cuts.join(known.select(F.col("key").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(known.select(F.col("key").alias("tail"), F.col("f").alias("r")), "tail")
    score = F.expr("cast(2000000 as decimal(20, 0)) * cast(a as decimal(18, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    best = cuts.withColumn("score", score).groupBy("key", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = phrases.where(size > 2)
    starts = F.explode(F.sequence(F.lit(1), size - 1)).alias("start")
    inner = longer.select("key", "f", starts).select(
        "key", "f", "start", F.explode(F.sequence(F.lit(2), F.least(size - 1, size - F.col("start") + 1))).alias("length")
    )
    inner = inner.select(F.slice("key", F.col("start"), F.col("length")).alias("key"), "f").groupBy("key").agg(F.max("f").alias("around"))
    exact = "decimal(30, 0)"
    covered = (F.col("around").cast(exact) * 100 >= F.col("a").cast(exact) * COVER_PERCENT)
    kept = best.join(inner, "key", "left").where("around IS NULL").unionByName(best.join(inner, "key").where(~covered))

    spelled = kept.select("key", "a", "cut", F.posexplode("key").alias("at", "code")).join(named.select("lang", "word", "code"), "code")
    inside = spelled.groupBy("key", "a", "cut").agg(
        F.first("lang").alias("lang"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"),
    )
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    flat = inside.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    first = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(F.broadcast(total) if total.limit(10_001).count() <= 10_000 else total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
