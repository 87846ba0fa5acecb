"""N-gram Jaccard join: subsets for small sets, inverted lists for large ones, links whole for any size of group."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradloom.llm.batches import bounded_batches, map_arrow
from gradloom.llm.kernels import Texts, Words, mix, sequence, slices, window_hashes, windows_inside
from gradloom.llm.meeting import screened_members
from gradloom.plans.kernels import sum_partials
from gradloom.session import reliable_checkpoint, scratch_path

SHINGLE_WORDS = 3
PERCENT = 90
# What reading one entry of an inverted list and checking it costs, in units of writing one key.
SCAN_COST = 4
# Measured lists longer than this do not move the boundary further: subsets of a set stay below some 2,000.
LONGEST_SCAN = 64
# Cells of the tables of shingles and of words, as powers of two: 3 MB for every task, half of it broadcast.
COUNT_BITS, WORD_BITS = 18, 17
# Tables of counts that the driver adds up itself.
COUNTS_BYTES = 8 * 1024 * 1024
# Eight bytes of parities laid side by side at once.
COMPARED_WORDS = 1 << 19
# Bits of a parity, as powers of two.
MIN_PARITY, MAX_PARITY = 6, 17
# Largest group that one task compares by itself, in sets and in shingles; a larger one is compared in blocks of these sizes.
GROUP_SETS, GROUP_SHINGLES = 1024, 2_000_000
# Rows of a few numbers that are broadcast after counting them; more are shuffled.
SHIPPED_ROWS = 200_000
LIST_CODE = sequence(1 << 40, 1)[0]


def shingle_sets(column: pa.Array, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The distinct shingle hashes of every text, sorted: runs of ``width`` lower-cased words, or all words if fewer."""
    return [items for items, _ in ranked_sets(column, width)]


def ranked_sets(column: pa.Array, width: int, counts: ShingleCounts | None = None) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """``shingle_sets`` with the rarity of every shingle where ``counts`` are given."""
    words = Words(Texts(column))
    hashes = words.hashes(lower=True)
    shingles = window_hashes(hashes, width)
    ranks = None if counts is None else counts.rarity(hashes, shingles, width)
    bounds, out = words.bounds.tolist(), []
    for low, high in zip(bounds, bounds[1:]):
        if high - low >= width:
            window = slice(low, high - width + 1)
            if ranks is None:
                out.append((np.unique(shingles[window]), None))
            else:
                items, first = np.unique(shingles[window], return_index=True)
                out.append((items, ranks[window][first]))
        elif high > low:
            with np.errstate(over="ignore"):
                items = mix(window_hashes(hashes[low:high], high - low) + np.uint64(high - low))
            out.append((items, None if counts is None else np.zeros(1, np.int32)))
        else:
            out.append((np.zeros(0, np.uint64), None))
    return out


def most_apart(total, percent: int):
    """Largest symmetric difference of two linked sets whose sizes add up to ``total``."""
    return (100 - percent) * total // (100 + percent)


def subset_count(size: int, percent: int) -> int:
    """Subsets that a small set of this size is listed under."""
    return sum(math.comb(size, d) for d in range((100 - percent) * size // 100 + 1))


def boundary(percent: int, scan_cost: float = SCAN_COST) -> int:
    """Largest size for which writing all subsets costs less than listing the rarest items and scanning these lists.

    A list is read twice (for its length and for its members); two lists more than needed are reckoned for sets that
    differ in size.
    """
    size = 1
    while subset_count(size + 1, percent) <= 2 * scan_cost * (listed_items(size + 1, percent) + 2):
        size += 1
    return size


def listed_items(size: int, percent: int) -> int:
    """Items of a set of which one at least is in every set that links with it."""
    return size - -(-percent * size // 100) + 1


class ShingleCounts:
    """How often words and shingles occur, by hash cell: two tables of fixed size for a corpus of any size.

    ``rarity`` puts a text's shingles in order: those whose cell stands out as common last, the others by how rarely their
    words would meet by chance. Any order that all sets share gives right results; a good one gives short lists.
    """

    def __init__(self, words: np.ndarray, shingles: np.ndarray):
        # Logarithms in sixteenths; sums of them are exact.
        self.words = np.rint(16 * np.log2(words + 1.0)).astype(np.int32)
        usual = float(np.median(shingles)) + 1.0
        high = usual + 6.0 * np.sqrt(usual)
        self.common = np.where(shingles > high, np.log2(np.maximum(shingles / high, 1.0)) + 1.0, 0.0).astype(np.int32)
        total = float(shingles.sum())
        # Length of the list that a random occurrence is on, beyond what chance puts into its cell.
        self.list_length = max(1.0, float((shingles**2).sum()) / total - total / len(shingles)) if total else 1.0

    def rarity(self, words: np.ndarray, shingles: np.ndarray, width: int) -> np.ndarray:
        """A rank of every run of ``width`` words, small for rare ones."""
        at = self.words[_cell(words, WORD_BITS)]
        n = len(shingles)
        return sum((at[k : n + k] for k in range(width)), self.common[_cell(shingles, COUNT_BITS)] * np.int32(1 << 20))


def _cell(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def count_shingles(documents: DataFrame, width: int = SHINGLE_WORDS) -> ShingleCounts:
    """Count words and shingles of all documents; tasks send one table each, and these are added up on the executors."""
    cells = (1 << WORD_BITS) + (1 << COUNT_BITS)

    def count(batches):
        total = np.zeros(cells)
        for whole in batches:
            for batch in slices(whole):
                words = Words(Texts(batch.column("text")))
                hashes = words.hashes(lower=True)
                shingles = window_hashes(hashes, width)[windows_inside(words.bounds, width, len(hashes) - width + 1)]
                total[: 1 << WORD_BITS] += np.bincount(_cell(hashes, WORD_BITS), minlength=1 << WORD_BITS)
                total[1 << WORD_BITS :] += np.bincount(_cell(shingles, COUNT_BITS), minlength=1 << COUNT_BITS)
        return 0.0, 0.0, total

    texts = bounded_batches(documents.select("text"))
    _, _, total = sum_partials(texts, count, texts.rdd.getNumPartitions(), cells, COUNTS_BYTES)
    return ShingleCounts(total[: 1 << WORD_BITS], total[1 << WORD_BITS :])


class Index:
    """The keys of a set. Two linked sets share a key; what shares a key is then compared.

    Small sets are listed under subsets of themselves, large ones on the inverted lists of their rarest shingles. The
    boundary lies where writing subsets would cost more than writing and scanning lists, whose length is measured.
    """

    def __init__(self, percent: int = PERCENT, counts: ShingleCounts | None = None):
        self.percent, self.counts = percent, counts
        self.boundary = boundary(percent) if counts is None else boundary(percent, min(counts.list_length, LONGEST_SCAN))
        # Sets this large can link with a set beyond the boundary.
        self.first = -(-percent * (self.boundary + 1) // 100)

    def keys(self, items: np.ndarray, ranks: np.ndarray | None = None) -> np.ndarray:
        found = []
        if len(items) <= self.boundary:
            found.append(self.subset_keys(items))
        if len(items) >= self.first:
            found.append(self.list_keys(items, ranks))
        return np.concatenate(found)

    def subset_keys(self, items: np.ndarray) -> np.ndarray:
        """Every subset of fixed sizes: all items but 0, 1, … of them, as many as a linked set may lack."""
        with np.errstate(over="ignore"):
            coded = mix(items)
            total, out = coded.sum(dtype=np.uint64), []
            for d in range((100 - self.percent) * len(items) // 100 + 1):
                dropped = [sum(c, np.uint64(0)) for c in combinations(coded, d)] if d else [np.uint64(0)]
                out.append(mix(total - np.array(dropped, np.uint64)) + np.uint64(len(items) - d))
        return np.concatenate(out)

    def list_keys(self, items: np.ndarray, ranks: np.ndarray | None = None) -> np.ndarray:
        """The inverted lists of the rarest items, one item more than a linked set may lack: linked sets share one of them.

        Rare by ``ranks``, then by hash. A passage that many documents share comes last and is on nobody's lists, unless a
        text holds little else.
        """
        need = listed_items(len(items), self.percent)
        if ranks is not None:
            items = items[np.argsort(ranks, kind="stable")[:need]]
        with np.errstate(over="ignore"):
            return mix(items[:need] + LIST_CODE)


def parity(items: np.ndarray) -> bytes:
    """Bits that say of how many items, even or odd, fell there; one or two bits an item.

    Sets that differ in k items differ in k bits at most, whatever their sizes: more bits of one side fold together.
    """
    bits = 1 << max(MIN_PARITY, min(MAX_PARITY, len(items).bit_length()))
    odd = np.bincount((items >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class ParityScreen:
    """Which pairs may link by sizes and parities: no pair that links is held back."""

    def __init__(self, percent: int):
        self.percent = percent

    def prepare(self, sizes: np.ndarray, sketches: list[bytes]):
        """Sizes, width class and place of every set, and the sets of each class folded to each smaller one."""
        widths = np.array([len(s) // 8 for s in sketches])
        kinds, kind = np.unique(widths, return_inverse=True)
        place, folded = np.zeros(len(sketches), np.int64), {}
        for k, wide in enumerate(kinds.tolist()):
            at = np.flatnonzero(kind == k)
            place[at] = np.arange(len(at))
            held = np.frombuffer(b"".join(sketches[i] for i in at), np.uint64)
            for j, narrow in enumerate(kinds[: k + 1].tolist()):
                folded[k, j] = np.bitwise_xor.reduce(held.reshape(len(at), wide // narrow, narrow), axis=1)
        return sizes, kind, place, folded

    def may_link(self, ready, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sizes, kind, place, folded = ready
        small, large = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
        good = 100 * small >= self.percent * large
        at = np.flatnonzero(good)
        pair = kind[left[at]] * len(folded) + kind[right[at]]
        for code in np.unique(pair).tolist():
            a, b = divmod(code, len(folded))
            width = folded[min(a, b), min(a, b)].shape[1]
            some = at[pair == code]
            step = max(1, COMPARED_WORDS // width)
            for start in range(0, len(some), step):
                part = some[start : start + step]
                one, other = folded[a, min(a, b)][place[left[part]]], folded[b, min(a, b)][place[right[part]]]
                apart = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)
                good[part] = apart <= most_apart(sizes[left[part]] + sizes[right[part]], self.percent)
        return good


def signatures(
    documents: DataFrame, percent: int = PERCENT, width: int = SHINGLE_WORDS, counts: ShingleCounts | None = None
) -> DataFrame:
    """doc_id, text_key, n_shingles, sig_a, sig_b (128 bits that equal sets share), index keys and parity of every row."""
    shipped = documents.sparkSession.sparkContext.broadcast(Index(percent, counts))

    def sign(batches):
        index = shipped.value
        for whole in batches:
            for batch in slices(whole.select(["doc_id", "text_key", "text"])):
                ranked = ranked_sets(batch.column("text"), width, index.counts)
                keys = [index.keys(s, r).view(np.int64) if len(s) else np.zeros(0, np.int64) for s, r in ranked]
                sets = [s for s, _ in ranked]
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
                sizes = pa.array([len(s) for s in sets], pa.int64())
                sketch = pa.array([parity(s) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], sizes, *signed(sets), lists, sketch],
                    names=["doc_id", "text_key", "n_shingles", "sig_a", "sig_b", "keys", "sketch"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        documents.select("doc_id", text_key().alias("text_key"), "text"),
        sign,
        f"doc_id {kind}, text_key bigint, n_shingles bigint, sig_a bigint, sig_b bigint, keys array<bigint>, sketch binary",
    )


def text_key(text="text"):
    """Digest that, next to the doc_id, names a row and its exact copies."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def signed(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two sums of hashes that name a set."""
    with np.errstate(over="ignore"):
        a = [mix(s).sum(dtype=np.uint64) for s in sets]
        b = [mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets]
    return [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (a, b)]


def link_components(documents: DataFrame, percent: int = PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row.

    Two documents link when 100 * |A and B| >= percent * |A or B|, in shingles of ``width`` words. The steps: equal sets become one class; classes write
    their keys (``Index``); keys that two classes share make groups around their smallest class; each group is
    screened by sketches, then compared exactly, and only links that join something new come out; components are labelled.
    No pair of a group is ever a row. Null and wordless texts have no shingles and link with nothing: their component is
    their own doc_id. Repeated rows link with each other; rows without a doc_id take the smallest one of their
    component, or null. An empty table gives no rows.
    """
    return link_rows(documents, percent, width).select("doc_id", "n_shingles", "component_id")


def link_rows(documents: DataFrame, percent: int = PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """``link_components`` with text_key of every row, and comp: a number of its component, null where it has no shingles."""
    spark = documents.sparkSession
    path = scratch_path(spark, "sets")
    counts = count_shingles(documents, width)
    # Written once, so a row (and below, a class) keeps its number whatever is recomputed later.
    signatures(documents, percent, width, counts).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{path}/signed")
    rows = spark.read.parquet(f"{path}/signed")
    classes = equal_sets(rows, f"{path}/classes")
    named = rows.join(classes.select("row", "node"), "row")
    entries = named.select("node", F.explode("keys").alias("key"))
    members = screened_members(entries, named.select("node", F.col("n_shingles").alias("size"), "sketch"), ParityScreen(percent))
    sets = candidate_sets(documents, classes, members, f"{path}/candidates", width)
    return labelled_rows(rows, classes, reliable_checkpoint(links_in_groups(members, sets, percent)))


SAME = ["n_shingles", "sig_a", "sig_b"]


def equal_sets(rows: DataFrame, path: str, *kept) -> DataFrame:
    """Classes of equal, filled sets, written with a number (node), the smallest doc_id, one (doc_id, text_key) and one row."""
    (
        rows.where("n_shingles > 0")
        .groupBy(*SAME)
        .agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_key")).alias("one"), F.min("row").alias("row"), *kept)
        .withColumn("node", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    return rows.sparkSession.read.parquet(path)


def labelled_rows(rows: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and comp of every row, from links (a, b) between classes."""
    labels = components(links)
    named = classes.select(*SAME, "node", "least").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    smallest = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = named.join(smallest, "comp", "left").select(*SAME, "comp", "component_id")
    return (
        rows.select("doc_id", "text_key", *SAME)
        .join(found, SAME, "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .select("doc_id", "text_key", "n_shingles", "component_id", "comp")
    )


def candidate_sets(documents: DataFrame, classes: DataFrame, members: DataFrame, path: str, width: int) -> DataFrame:
    """node, size and items (sorted 64-bit hashes) of every class in a group, from the text of one of its documents."""
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "one")
    same = F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (text_key() == F.col("one.text_key"))
    if wanted.limit(SHIPPED_ROWS + 1).count() <= SHIPPED_ROWS:
        wanted = F.broadcast(wanted)  # a few numbers a row; texts then stay where they are
    texts = documents.select("doc_id", "text").join(wanted, same).select("node", "text")

    def build(batches):
        for whole in batches:
            for batch in slices(whole):
                sets = shingle_sets(batch.column("text"), width)
                sizes = pa.array([len(s) for s in sets], pa.int64())
                items = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("node"), sizes, items], names=["node", "size", "items"])

    found = map_arrow(texts, build, "node bigint, size bigint, items binary")
    found.groupBy("node").agg(F.first("size").alias("size"), F.first("items").alias("items")).write.parquet(path)
    return documents.sparkSession.read.parquet(path)


LINKS = "a bigint, b bigint"


def links_in_groups(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect what a group holds.

    A group of bounded size is compared in one task. In a larger one every set is compared with the center first; sets that
    link with it are connected already, and the remaining ones are compared with all sets of the group in blocks.
    """
    sized = members.join(sets.select("node", "size"), "node")
    weight = sized.groupBy("center").agg(F.count("*").alias("sets"), F.sum("size").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("sets") / GROUP_SETS), F.ceil(F.col("shingles") / GROUP_SHINGLES)).cast("int")
    weight = reliable_checkpoint(weight.where("sets > 1").select("center", parts.alias("parts")))

    small = members.join(weight.where("parts = 1").select("center"), "center").join(sets, "node").select("center", "node", "items")

    def compare(table: pa.Table) -> pa.Table:
        nodes, held = _unpacked(table)
        return _pairs(linked_pairs(nodes, held, percent))

    found = small.groupBy("center").applyInArrow(compare, LINKS)

    large = members.join(weight.where("parts > 1"), "center")
    core = large.select("center", "parts").distinct().join(sets.select(F.col("node").alias("center"), F.col("items").alias("middle")), "center")
    judged = large.join(sets, "node").join(core.select("center", "middle"), "center")
    schema = "center bigint, parts int, node bigint, items binary, linked boolean"

    def with_center(batches):
        for batch in batches:
            rows = zip(batch.column("items").to_pylist(), batch.column("middle").to_pylist())
            linked = [_linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("center", "parts", "node", "items")), pa.array(linked, pa.bool_())],
                names=["center", "parts", "node", "items", "linked"],
            )

    star = map_arrow(judged, with_center, schema)
    path = scratch_path(members.sparkSession, "stars")
    star.write.parquet(path)
    star = members.sparkSession.read.parquet(path)
    direct = star.where("linked").select(F.col("center").alias("a"), F.col("node").alias("b")).where("a <> b")
    block = F.pmod(F.xxhash64("node"), F.col("parts"))
    outside = star.where("NOT linked").withColumn("row", block).withColumn("column", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    whole = star.withColumn("column", block)
    rows = outside.select("center", "row", "column", "node", "items", F.lit(True).alias("outside"))
    held = outside.select("center", "row").distinct().join(whole, "center").select(
        "center", "row", "column", "node", "items", F.lit(False).alias("outside")
    )

    def compare_blocks(table: pa.Table) -> pa.Table:
        out = table.column("outside").combine_chunks().to_numpy(zero_copy_only=False)
        at = np.flatnonzero(out), np.flatnonzero(~out)
        nodes, held = _unpacked(table)
        return _pairs(crossing_pairs(*[([nodes[i] for i in rows], [held[i] for i in rows]) for rows in at], percent))

    crossed = rows.unionByName(held).groupBy("center", "row", "column").applyInArrow(compare_blocks, LINKS)
    return found.unionByName(direct).unionByName(crossed).distinct()


def _unpacked(table: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    return table.column("node").to_pylist(), [np.frombuffer(x, "<u8") for x in table.column("items").to_pylist()]


def _pairs(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})


def _enough(overlap, sizes_a, sizes_b, percent: int):
    return 100 * overlap >= percent * (sizes_a + sizes_b - overlap)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    return bool(_enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of left with right sets, as products of 0/1 matrices over the items both sides hold."""
    a, b = np.concatenate(left), np.concatenate(right)
    row_a = np.repeat(np.arange(len(left)), [len(s) for s in left])
    row_b = np.repeat(np.arange(len(right)), [len(s) for s in right])
    shared = np.intersect1d(a, b)
    total = np.zeros((len(left), len(right)), np.float32)
    at_a, at_b = np.searchsorted(shared, a), np.searchsorted(shared, b)
    in_a = shared[np.minimum(at_a, max(len(shared) - 1, 0))] == a if len(shared) else np.zeros(len(a), bool)
    in_b = shared[np.minimum(at_b, max(len(shared) - 1, 0))] == b if len(shared) else np.zeros(len(b), bool)
    at_a, row_a, at_b, row_b = at_a[in_a], row_a[in_a], at_b[in_b], row_b[in_b]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    at_a, row_a, at_b, row_b = at_a[order_a], row_a[order_a], at_b[order_b], row_b[order_b]
    width = 4096
    for low in range(0, len(shared), width):
        sides = []
        for at, row, n in ((at_a, row_a, len(left)), (at_b, row_b, len(right))):
            first, last = np.searchsorted(at, [low, low + width])
            side = np.zeros((n, width), np.float32)
            side[row[first:last], at[first:last] - low] = 1.0
            sides.append(side)
        total += sides[0] @ sides[1].T
    return total.astype(np.int64)


def linked_pairs(nodes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links among the sets of one group that connect all that is linked in it; at most one fewer than sets."""
    if len(sets) < 8:
        every = [(i, j) for i in range(len(sets)) for j in range(i) if _linked(sets[i], sets[j], percent)]
    else:
        sizes = np.array([len(s) for s in sets])
        good = _enough(overlaps(sets, sets), sizes[:, None], sizes[None, :], percent)
        every = [(i, j) for i, j in np.argwhere(np.tril(good, -1)).tolist()]
    return [(nodes[i], nodes[j]) for i, j in _forest(every)]


def crossing_pairs(left: tuple[list[int], list[np.ndarray]], right: tuple[list[int], list[np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """As ``linked_pairs``, between the sets of two blocks."""
    if not left[0] or not right[0]:
        return []
    sizes = [np.array([len(s) for s in side[1]]) for side in (left, right)]
    good = _enough(overlaps(left[1], right[1]), sizes[0][:, None], sizes[1][None, :], percent)
    pairs = [(left[0][i], right[0][j]) for i, j in np.argwhere(good).tolist() if left[0][i] != right[0][j]]
    return _forest(pairs)


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs that join two parts not joined by earlier ones."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    kept = []
    for a, b in pairs:
        x, y = top(a), top(b)
        if x != y:
            above[x] = y
            kept.append((a, b))
    return kept


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node on a link: comp is the smallest node that links lead to.

    Each round takes the smallest label among neighbours and then the label of that label, so long chains shrink by
    half; rounds end when no label changes. Labels are checkpointed and never collected.
    """
    edges = reliable_checkpoint(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = reliable_checkpoint(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        seen = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        far = labels.select(F.col("node").alias("next"), F.col("comp").alias("far"))
        stepped = seen.join(far, "next").select("node", F.least("next", "far").alias("comp"), (F.least("next", "far") < F.col("comp")).alias("moved"))
        stepped = reliable_checkpoint(stepped)
        labels = stepped.drop("moved")
        if not stepped.where("moved").head(1):
            return labels
