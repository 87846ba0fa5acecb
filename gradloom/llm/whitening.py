"""Whitening of embeddings by shifted CholeskyQR: Gram passes, triangular solves, an SVD of the composed factor."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradloom.llm.batches import bounded_batches, map_arrow
from gradloom.plans.kernels import check_broadcast, sum_partials
from gradloom.session import reliable_checkpoint

COMPONENTS = 4
# Steps of a vector's entries.
SCALE = 256.0
# Orthogonalising passes: one with a shift, then as many as are needed; three do up to a condition of 1e15.
PASSES = 6
# Directions whose deviation is less than this share of the largest one's count as constant.
FLAT = 1e-12
LONGS = np.iinfo(np.int64)


def quantised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a filled vector of finite numbers, and floor(256 * c) + 0 of all their entries, one after another."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    flat = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    row = np.repeat(np.arange(len(column)), lengths)
    bad = np.bincount(row[~np.isfinite(flat)], minlength=len(column)) > 0  # nulls read as NaN
    good = np.asarray(column.is_valid()) & ~bad & (lengths > 0)
    steps = np.floor(SCALE * flat[good[row]])
    values = np.clip(steps, -(2.0**63), 2.0**63 - 1024).astype(np.int64)  # up to the largest double below 2^63
    return good, np.where(steps >= 2.0**63, LONGS.max, values)


def pack(values: np.ndarray, rows: int) -> list[bytes]:
    """Rows of equal length in the fewest bytes an entry that hold each row, led by that number."""
    table = values.reshape(rows, -1)
    low, high = table.min(axis=1), table.max(axis=1)
    out: list[bytes] = [b""] * rows
    left = np.ones(rows, bool)
    for kind in (np.int8, np.int16, np.int32, np.int64):
        held = np.iinfo(kind)
        fits = left & (low >= held.min) & (high <= held.max)
        left &= ~fits
        narrow = table[fits].astype(kind)
        for at, line in zip(np.flatnonzero(fits).tolist(), narrow):
            out[at] = bytes([narrow.itemsize]) + line.tobytes()
    return out


def unpack(column: pa.Array, width: int) -> np.ndarray:
    """The rows of ``pack`` as longs."""
    codes = column.to_pylist()
    kinds = np.array([c[0] for c in codes])
    out = np.empty((len(codes), width), np.int64)
    for size in np.unique(kinds):
        at = np.flatnonzero(kinds == size)
        out[at] = np.frombuffer(b"".join(codes[i][1:] for i in at), f"i{size}").reshape(len(at), width)
    return out


@dataclass
class Whitening:
    """n distinct vectors with sums S; ``components`` are columns of unit length, largest ``values`` first."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Decimal(s) / Decimal(self.n)) for s in self.sums])

    def apply(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) @ self.components) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> np.ndarray | np.ma.MaskedArray:
        """Sum of (n * x - S)^2 over dimensions, exact; masked where a long cannot hold it."""
        largest = self.n * int(max(abs(int(x.max())), abs(int(x.min())))) + max(abs(s) for s in self.sums)
        if largest**2 * x.shape[1] <= LONGS.max:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return np.ma.array([e if e <= LONGS.max else 0 for e in exact], dtype=np.int64, mask=[e > LONGS.max for e in exact])


def packed_vectors(table: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """vec_id and code (the quantised vector) of every row that takes part, and the width."""
    sizes = table.groupBy(F.size(column).alias("width")).count().where("width > 0")
    common = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    width = common["width"] if common else 0

    def encode(batches):
        for batch in batches:
            good, values = quantised(batch.column("vector"))
            ids = batch.column("vec_id").filter(pa.array(good))
            codes = pack(values, int(good.sum())) if good.any() else []
            yield pa.RecordBatch.from_arrays([ids, pa.array(codes, pa.binary())], names=["vec_id", "code"])

    kind = table.schema["vec_id"].dataType.simpleString()
    held = table.where(F.size(column) == width).select("vec_id", F.col(column).alias("vector"))
    return map_arrow(held, encode, f"vec_id {kind}, code binary"), width


def fit_whitening(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors in ``fit`` (code binary, checkpointed); None where nothing varies.

    Shifted CholeskyQR: the Gram matrix G of the centred rows is summed up over tasks, G + shift = R'R, and the rows times
    the inverse of R (a triangular solve per batch) are closer to orthonormal. Passes repeat on them until their Gram matrix is
    the identity, so that squaring the condition does no harm; X = Q (Rk ... R2 R1), and the SVD of the last Gram factor times
    the composed R gives the components and eigenvalues. Rows stay where they are; a pass brings one matrix to the
    driver. Directions in which nothing varies keep their shift and come out with value 0, so they are left out.
    """
    n, sums = _sums(fit, width)
    if n < 2:
        return None
    check_broadcast(8 * width * width, "the triangular factor")
    centre = np.array([float(Decimal(s) / Decimal(n)) for s in sums])
    factor, gram = np.eye(width), None
    parts = fit.rdd.getNumPartitions()
    for done in range(PASSES + 1):
        gram = _gram(fit, centre, factor, parts)
        if done and np.abs(gram - np.eye(width)).max() < 1e-13 * width or done == PASSES:
            break
        scale = np.linalg.norm(gram, 2)
        if not scale > 0:
            return None
        # The published shift; further passes need one only where a direction is flat.
        shift = 11.0 * (n * width + width * (width + 1)) * np.finfo(float).eps * scale if not done else 0.0
        shift = min(shift, 1e-6 * scale)
        upper = _cholesky(gram, shift, scale)
        factor = upper @ factor
    values, vectors = np.linalg.eigh(gram)
    half = np.sqrt(np.maximum(values, 0.0))[:, None] * vectors.T  # half' half = gram
    _, singular, right = np.linalg.svd(half @ factor)
    used = min(components, int((singular > FLAT * singular[0]).sum()))
    model = Whitening(n, sums, right[:used].T, singular[:used] ** 2 / n, float((singular**2).sum() / n))
    model.identity_error = _identity_error(fit, model, width, parts)
    return model


def _cholesky(gram: np.ndarray, shift: float, scale: float) -> np.ndarray:
    """Upper R with R'R = gram + shift, a larger shift where rounding leaves it without one."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10.0 * shift, 1e-15 * len(gram) * scale)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension; one row per task and dimension is shuffled."""

    def add(batches):
        n, total = 0, [0] * width
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unpack(batch.column("code"), width)
            wide = max(abs(int(x.max())), abs(int(x.min()))) * len(x) > LONGS.max
            total = [t + int(s) for t, s in zip(total, (x.astype(object) if wide else x).sum(axis=0))]
            n += len(x)
        yield pa.RecordBatch.from_pydict(
            {"at": pa.array(range(width), pa.int32()), "n": pa.array([n] * width, pa.int64()), "s": pa.array([str(t) for t in total])}
        )

    found = map_arrow(fit, add, "at int, n bigint, s string").groupBy("at")
    rows = found.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()
    return (rows[0]["n"], [int(r["s"]) for r in rows]) if rows else (0, [0] * width)


def _gram(fit: DataFrame, centre: np.ndarray, factor: np.ndarray, parts: int) -> np.ndarray:
    """Q'Q of the centred rows Q = X / factor."""
    width = len(centre)
    shipped = fit.sparkSession.sparkContext.broadcast((centre, factor))

    def square(batches):
        middle, upper = shipped.value
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                rows = np.linalg.solve(upper.T, (unpack(batch.column("code"), width) - middle).T)
                total += rows @ rows.T
        return 0.0, 0.0, total.ravel()

    _, _, total = sum_partials(bounded_batches(fit), square, parts, width * width)
    shipped.destroy()
    total = total.reshape(width, width)
    return (total + total.T) / 2.0


def _identity_error(fit: DataFrame, model: Whitening, width: int, parts: int) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured over the fit list."""
    used = len(model.values)

    def second(batches):
        total = np.zeros((used + 1, used))
        for batch in batches:
            if batch.num_rows:
                w = model.apply(unpack(batch.column("code"), width))
                total[:used] += w.T @ w
                total[used] += w.sum(axis=0)
        return 0.0, 0.0, total.ravel()

    _, _, total = sum_partials(bounded_batches(fit), second, parts, (used + 1) * used)
    total = total.reshape(used + 1, used) / model.n
    return float(np.abs(total[:used] - np.outer(total[used], total[used]) - np.eye(used)).max())


WHITENED = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every row that takes part.

    Rows whose vector is null, empty or holds null, NaN or infinite entries are left out, and so are rows of another
    than the commonest length (of equally common ones the longest). Entries become floor(256 * c), beyond 64 bits the
    nearest long; a deviation that takes more is null. The fit list holds every distinct vector once: rows are compared as codes of a byte or more an
    entry, combined in map tasks first, so a vector that a third of all rows repeat is one code per task. Repeated rows
    and rows without a vec_id get their results as any other. Components in which nothing varies do not come out: an empty table, or one with
    a single distinct vector, gives no rows. Further columns are not looked at.
    """
    rows, width = packed_vectors(table, column)
    kind = table.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, {WHITENED}"
    model = fit_whitening(reliable_checkpoint(rows.select("code").distinct()), width, components) if width else None
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    shipped = table.sparkSession.sparkContext.broadcast(model)

    def project(batches):
        held = shipped.value
        used = len(held.values)
        explained = held.values / held.trace
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unpack(batch.column("code"), width)
            far = held.deviations(x)
            far = pa.array(np.repeat(np.ma.getdata(far), used), mask=np.repeat(np.ma.getmaskarray(far), used))
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), used)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * used, held.n)),
                    far, pa.array(held.apply(x).ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * used, held.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_arrow(rows, project, schema)
