"""HyperMinHash near-duplicates: 16-bit registers of leading zeros and mantissa, banded, estimated, then verified."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradloom.llm.batches import map_arrow
from gradloom.llm.jaccard import candidate_sets, equal_sets, labelled_rows, links_in_groups, shingle_sets, signed, text_key
from gradloom.llm.kernels import mix, sequence, slices
from gradloom.llm.meeting import screened_members
from gradloom.session import reliable_checkpoint, scratch_path

SHINGLE_WORDS = 4
PERCENT = 80
# Registers of a set, one per bucket of its hashes, and bits of mantissa kept beside the 6 for leading zeros.
REGISTERS, MANTISSA_BITS = 128, 10
# Registers of a band. Sets of Jaccard 0.8 share none of the 32 bands with probability (1 - 0.8^4)^32 = 5e-8.
BAND = 4
# Estimates may lie this many standard deviations under the threshold before a pair is left out (about 1e-9).
DEVIATIONS = 6.0

BUCKET_BITS = REGISTERS.bit_length() - 1
BUCKETS = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
# Bits of a hash behind its bucket that a double holds exactly.
RANK_BITS = 53
# In which order an empty bucket asks the others for their register; its own place comes first.
ASKED = np.stack([
    np.r_[i, [j for j in np.argsort(sequence((i + 1) << 44, REGISTERS)) if j != i]] for i in range(REGISTERS)
])
BAND_CODES = sequence(1 << 52, REGISTERS // BAND)
# Pairs whose registers are laid side by side at once.
COMPARED = 1 << 15


def registers(items: np.ndarray) -> np.ndarray:
    """The 128 registers of a sorted array of 64-bit hashes: 1 + leading zeros of each bucket's least hash, then mantissa.

    The first 7 bits of a hash are its bucket. The least of a bucket is stored as a floating-point number would be: its
    leading zeros exactly, and the 10 bits behind the first one. Empty buckets take the register of the first filled
    one in an order of their own, so that small sets fill all bands and equal registers stay as likely as the Jaccard.
    An empty set has registers 0.
    """
    out = np.zeros(REGISTERS, np.uint16)
    if not len(items):
        return out
    at = np.searchsorted(items, BUCKETS)
    filled = at < np.r_[at[1:], len(items)]
    least = (items[at[filled]] << np.uint64(BUCKET_BITS)) >> np.uint64(64 - RANK_BITS)
    fraction, exponent = np.frexp(least.astype(np.float64))
    mantissa = np.maximum((2.0 * fraction - 1.0) * (1 << MANTISSA_BITS), 0.0).astype(np.uint16)
    out[filled] = ((RANK_BITS - exponent + 1).astype(np.uint16) << np.uint16(MANTISSA_BITS)) | mantissa
    if filled.all():
        return out
    return out[ASKED[np.arange(REGISTERS), filled[ASKED].argmax(axis=1)]]


def band_keys(table: np.ndarray) -> np.ndarray:
    """One key per band of every row of registers: four registers are 64 bits, told apart by the band."""
    return mix(np.ascontiguousarray(table).view(np.uint64).reshape(len(table), -1) ^ BAND_CODES)


@lru_cache(maxsize=1024)
def _chance(quarter_octaves: int) -> float:
    """Probability that registers of two unlike buckets agree, of 2^(quarter_octaves / 4) hashes each."""
    load = 2.0 ** (quarter_octaves / 4)
    zeros = 2.0 ** -np.arange(1.0, RANK_BITS + 1)[:, None]
    steps = np.arange((1 << MANTISSA_BITS) + 1) / (1 << MANTISSA_BITS)
    # The least of ``load`` numbers lies beyond x with probability (1 - x)^load.
    beyond = np.exp(load * np.log1p(-np.minimum(zeros * (1.0 + steps), 1.0 - 1e-16)))
    return float(((beyond[:, :-1] - beyond[:, 1:]) ** 2).sum())


def chance(sizes: np.ndarray) -> np.ndarray:
    """Expected share of registers that agree by chance, for sets of these sizes."""
    load = np.maximum(np.asarray(sizes, np.float64) / REGISTERS, 1.0)
    found, back = np.unique(np.rint(4 * np.log2(load)).astype(int), return_inverse=True)
    return np.array([_chance(int(q)) for q in found])[back]


def estimates(equal: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard of pairs: the share of equal registers without those that collide by chance."""
    lucky = (chance(sizes_a) + chance(sizes_b)) / 2.0
    return (equal / REGISTERS - lucky) / (1.0 - lucky)


class EstimateScreen:
    """Which pairs may link: sizes exactly, the estimate with a margin of ``DEVIATIONS``."""

    def __init__(self, percent: int):
        self.percent, wanted = percent, percent / 100
        self.least = wanted - DEVIATIONS * np.sqrt(wanted * (1.0 - wanted) / REGISTERS)

    def prepare(self, sizes: np.ndarray, sketches: list[bytes]):
        return sizes, np.frombuffer(b"".join(sketches), np.uint16).reshape(-1, REGISTERS)

    def may_link(self, ready, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sizes, table = ready
        good = 100 * np.minimum(sizes[left], sizes[right]) >= self.percent * np.maximum(sizes[left], sizes[right])
        at = np.flatnonzero(good)
        for start in range(0, len(at), COMPARED):
            some = at[start : start + COMPARED]
            i, j = left[some], right[some]
            equal = (table[i] == table[j]).sum(axis=1)
            good[some] = estimates(equal, sizes[i], sizes[j]) >= self.least
        return good


def sketches(documents: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_key, n_shingles, sig_a, sig_b (128 bits that equal sets share) and sketch (registers) of every row."""

    def sign(batches):
        for whole in batches:
            for batch in slices(whole.select(["doc_id", "text_key", "text"])):
                sets = shingle_sets(batch.column("text"), width)
                sizes = pa.array([len(s) for s in sets], pa.int64())
                packed = pa.array([registers(s).tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], sizes, *signed(sets), packed],
                    names=["doc_id", "text_key", "n_shingles", "sig_a", "sig_b", "sketch"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        documents.select("doc_id", text_key().alias("text_key"), "text"),
        sign,
        f"doc_id {kind}, text_key bigint, n_shingles bigint, sig_a bigint, sig_b bigint, sketch binary",
    )


def banded(classes: DataFrame) -> DataFrame:
    """(node, key) for every band of every class."""

    def cut(batches):
        for batch in batches:
            table = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            nodes = np.repeat(batch.column("node").to_numpy(), REGISTERS // BAND)
            yield pa.RecordBatch.from_pydict({"node": nodes, "key": band_keys(table).ravel().view(np.int64)})

    return map_arrow(classes.select("node", "sketch"), cut, "node bigint, key bigint")


def near_duplicates(documents: DataFrame, percent: int = PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept (whether it is the row's own) of every row.

    Two documents link when 100 * |A and B| >= percent * |A or B|, in shingles of ``width`` words. Every row is read once
    into 256 bytes of registers. Equal sets become one class; classes that share a band meet; pairs whose corrected estimate lies far
    under the threshold are left out; what remains is confirmed on the full sets, read from the texts again; components
    of the links are labelled. No pair of a group is ever a row, and a group of any size is compared in blocks. A link of
    Jaccard ``percent`` is missed with a probability of 5e-8 (``BAND``) and 1e-9 (``DEVIATIONS``), larger ones less often;
    nothing that is no link comes out.

    Null, empty and wordless texts have no shingles and link with nothing: they are their own component and are kept.
    Repeated rows link with each other. Rows without a doc_id take the smallest one of their component, or null, and
    are kept only if it is null. An empty table gives no rows; other columns are not looked at.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "registers")
    # Written once, so that rows (and below, classes) keep their numbers whatever is recomputed later.
    sketches(documents, width).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{path}/sketches")
    rows = spark.read.parquet(f"{path}/sketches")
    classes = equal_sets(rows, f"{path}/classes", F.first("sketch").alias("sketch"))
    held = classes.select("node", F.col("n_shingles").alias("size"), "sketch")
    members = screened_members(banded(classes), held, EstimateScreen(percent))
    sets = candidate_sets(documents, classes, members, f"{path}/candidates", width)
    links = reliable_checkpoint(links_in_groups(members, sets, percent))
    found = labelled_rows(rows, classes, links)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
