"""Approximate nearest neighbours by an inverted multi-index."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradloom.functions.hashing import seeded_md5
from gradloom.llm.batches import map_arrow
from gradloom.session import scratch_path

# The codebooks are fitted on at most this many vectors, in seeded hash order.
FIT_VECTORS, FIT_ROUNDS = 20_000, 10
LEAST_CENTROIDS, MOST_CENTROIDS = 32, 1024
# A query visits cells until they hold this share of all vectors. On vectors without structure, recall
# follows the share; the value is the smallest round one that gives 0.9 on nearly isotropic vectors.
VISIT_SHARE = 0.5
# Rows of one block of entries, and of queries, that a task compares.
BLOCK = 8_192
# Scores this close to the last place are computed exactly, so that rounding decides no place.
CLOSE = 1e-9


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit_halves(sample: np.ndarray, centroids: int) -> list[np.ndarray]:
    """Centroids of the left and the right halves of unit vectors, by Lloyd's rounds from a seeded start."""
    middle = (sample.shape[1] + 1) // 2
    books = []
    for half in (sample[:, :middle], sample[:, middle:]):
        draw = np.random.default_rng(0).permutation(len(half))[:centroids]
        book = half[draw].copy()
        for _ in range(FIT_ROUNDS):
            near = nearest(half, book)
            counts = np.bincount(near, minlength=len(book))
            sums = np.zeros_like(book)
            np.add.at(sums, near, half)
            book[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        books.append(book)
    return books


def distances(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (book**2).sum(1)[None] - 2.0 * rows @ book.T


def nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    step = max(1, 4_000_000 // max(len(book), 1))
    found = [distances(rows[i : i + step], book).argmin(1) for i in range(0, len(rows), step)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def traverse(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: int) -> np.ndarray:
    """Which cells (i, j) to visit: pairs by growing left[i] + right[j], until their counts reach ``wanted``.

    A heap holds the border of the visited region over both sorted lists; each pair is pushed once, when its two lower
    neighbours are visited.
    """
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    x, y = left[a].tolist(), right[b].tolist()
    cells = counts[np.ix_(a, b)].tolist()
    reach = [0] * len(x)  # visited so far in each row of the sorted grid
    heap, held = [(x[0] + y[0], 0, 0)], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        reach[i] = j + 1
        held += cells[i][j]
        if j + 1 < len(y) and (i == 0 or reach[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if i + 1 < len(x) and reach[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
    seen = np.zeros(counts.shape, dtype=bool)
    for i, n in enumerate(reach):
        seen[a[i], b[:n]] = True
    return seen


def _matrix(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<f8").reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, in double precision; the same for the same two vectors everywhere."""
    dots = (rows * query).sum(axis=1)
    return dots / (np.sqrt((query * query).sum()) * np.sqrt((rows * rows).sum(axis=1)))


def nearest_neighbours(df: DataFrame, asks: Column, k: int = 5, id_name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), the id and the score of the ``k`` nearest vectors found for every row that ``asks``.

    Equal vectors are one entry with its ``k + 1`` smallest ids, so copies cost nothing and ties among them are exact. Halves
    of the unit vectors are quantised by two codebooks; each query visits the pairs of centroids by summed distance
    (``traverse``), and the entries of visited cells are ranked by their cosine on the original vectors, ties by id.
    Entries and queries meet in blocks: a cell that holds a third of all vectors is several blocks.
    Rows whose vector is not ``usable`` or whose id is null take no part; rows with the id of a query are its own. Shorter
    vectors read as padded with zeros. A query with fewer than ``k`` candidates gets all of them; none at all, no row.
    """
    spark = df.sparkSession
    rows = df.where(F.col(id_name).isNotNull() & usable(F.col(vector))).select(
        F.col(id_name).cast("bigint").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks")
    )
    path = scratch_path(spark, "index")
    first = F.row_number().over(W.partitionBy("vector").orderBy("id"))
    few = rows.select("vector", "id").distinct().withColumn("place", first).where(F.col("place") <= k + 1)
    ids = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asking = rows.groupBy("vector").agg(F.max("asks").alias("asks"))
    ids.join(asking, "vector").withColumn("entry", F.monotonically_increasing_id()).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")

    told = entries.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.sum(F.col("asks").cast("int")).alias("q")).head()
    total, width = told["n"], told["width"] or 1
    sample = entries.select("vector", F.col("ids")[0].alias("id")).orderBy(seeded_md5(0, F.col("id")), "id").limit(FIT_VECTORS)
    fitted = _padded(sample.select("vector").toArrow().column("vector").combine_chunks(), width)
    centroids = max(1, min(MOST_CENTROIDS, max(LEAST_CENTROIDS, round(math.sqrt(total) / 4)), len(fitted)))
    books = fit_halves(_unit(fitted), centroids) if total else [np.zeros((1, 1)), np.zeros((1, max(width - 1, 0)))]
    middle = books[0].shape[1]

    def encode(batches):
        for batch in batches:
            full = _padded(batch.column("vector"), width)
            unit = _unit(full)
            i, j = nearest(unit[:, :middle], books[0]), nearest(unit[:, middle:], books[1])
            packed = pa.array([v.astype("<f8").tobytes() for v in full], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("entry"), batch.column("first"), batch.column("asks"), packed, pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))],
                names=["entry", "first", "asks", "packed", "i", "j"],
            )

    coded = map_arrow(
        entries.select("entry", F.col("ids")[0].alias("first"), "asks", "vector"),
        encode,
        "entry bigint, first bigint, asks boolean, packed binary, i int, j int",
    )
    coded.write.parquet(f"{path}/coded")
    coded = spark.read.parquet(f"{path}/coded")
    counts = np.zeros((len(books[0]), len(books[1])), dtype=np.int64)
    for row in coded.groupBy("i", "j").count().collect():  # at most one row per pair of centroids
        counts[row["i"], row["j"]] = row["count"]
    best = _ranked_entries(coded, books, counts, max(k + 1, math.ceil(VISIT_SHARE * total)), told["q"] or 0, k + 1)

    found = best.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias(id_name))
    queries = rows.where("asks").select("id", "vector").distinct().join(entries.select("vector", F.col("entry").alias("query")), "vector")
    pairs = queries.select(F.col("id").alias("query_id"), "query").join(found, "query").where(F.col("query_id") != F.col(id_name))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), id_name))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", id_name, "score")


def _padded(column: pa.Array, width: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _ranked_entries(coded: DataFrame, books: list[np.ndarray], counts: np.ndarray, wanted: int, asked: int, k: int) -> DataFrame:
    """(query, entry, score) of the k best entries in the cells that each query entry visits."""
    middle = books[0].shape[1]
    # Cells of one left centroid are compared together, in blocks of entries and of queries.
    parts = np.maximum(1, -(-counts.sum(axis=1) // BLOCK)).tolist()
    query_blocks = max(1, -(-asked // BLOCK))

    def visit(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column("packed")))
            d = distances(unit[:, :middle], books[0]), distances(unit[:, middle:], books[1])
            at, left, cells = [], [], []
            for row in range(batch.num_rows):
                seen = traverse(d[0][row], d[1][row], counts, wanted)
                for i in np.flatnonzero(seen.any(axis=1) & (counts.sum(axis=1) > 0)).tolist():
                    at.append(row)
                    left.append(i)
                    cells.append(np.packbits(seen[i]).tobytes())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("entry").take(at), batch.column("packed").take(at), pa.array(left, pa.int32()), pa.array(cells, pa.binary())],
                names=["query", "packed", "i", "cells"],
            )

    asking = coded.where("asks").select("entry", "packed")
    visits = map_arrow(asking, visit, "query bigint, packed binary, i int, cells binary")
    part_count = F.get(F.array(*[F.lit(int(p)) for p in parts]), F.col("i"))
    queries = visits.withColumn("part", F.explode(F.sequence(F.lit(0), part_count - 1))).withColumn(
        "block", F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int")
    )
    held = (
        coded.select("entry", "first", "packed", "i", "j")
        .withColumn("part", F.pmod(F.xxhash64("entry"), part_count).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )

    def compare(asked: pa.Table, entries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if asked.num_rows and entries.num_rows:
            rows, lines = _matrix(entries.column("packed")), _matrix(asked.column("packed"))
            entry, first = entries.column("entry").to_numpy(), entries.column("first").to_numpy()
            cell = entries.column("j").to_numpy()
            mask = [np.unpackbits(np.frombuffer(c, np.uint8)).astype(bool) for c in asked.column("cells").to_pylist()]
            unit = _unit(rows).T.copy()
            names = asked.column("query").to_numpy()
            for low in range(0, len(lines), 256):
                rough = _unit(lines[low : low + 256]) @ unit
                for n in range(len(rough)):
                    score = np.where(mask[low + n][cell], rough[n], -np.inf)
                    open_ = int((score > -np.inf).sum())
                    if not open_:
                        continue
                    last = np.partition(score, -min(k, open_))[-min(k, open_)]
                    near = np.flatnonzero(score >= last - CLOSE)
                    exact = cosine(lines[low + n], rows[near])
                    order = np.lexsort((first[near], -exact))[:k]
                    out.append((np.full(len(order), names[low + n]), entry[near[order]], first[near[order]], exact[order]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query", "entry", "first", "score"])

    keys = ["i", "part", "block"]
    scored = queries.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(compare, "query bigint, entry bigint, first bigint, score double")
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "first"))
    return scored.withColumn("place", place).where(F.col("place") <= k).select("query", "entry", "score")
