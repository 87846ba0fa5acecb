"""Arrow batches as feature matrices, and sums of per-task arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradloom.session import BROADCAST_BYTES, map_arrow

# Partial sums brought to the driver in one go; more than this is added up on the executors first.
DRIVER_BYTES = 64 * 1024 * 1024
# Values of one slice of an array, and arrays added up by one task, when partials are added up on the executors.
SLICE_VALUES = 512 * 1024
FAN_IN = 64

PARTIAL_SCHEMA = "part int, slot int, loss double, weight double, sums binary"


class Dense:
    """A batch of ``features array<double>`` rows."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        lists = batch.column("features")
        if not (lists.value_lengths().to_numpy(zero_copy_only=False) == width).all():
            raise ValueError(f"dense rows must all hold {width} features")
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        self.x = np.asarray(flat, dtype=np.float64).reshape(batch.num_rows, width)

    def times(self, w: np.ndarray) -> np.ndarray:
        return self.x @ w

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return self.x.T @ r

    def squared_transposed_times(self, r: np.ndarray) -> np.ndarray:
        return (self.x**2).T @ r

    def columns(self, low: int, high: int) -> np.ndarray:
        return self.x[:, low:high]


class Sparse:
    """A batch of ``indices``/``values`` rows; ids at or beyond the trained width are left out."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        lists = batch.column("indices")
        if not lists.value_lengths().equals(batch.column("values").value_lengths()):
            raise ValueError("a sparse row needs as many values as indices")
        idx = lists.flatten().to_numpy(zero_copy_only=False)
        val = np.asarray(batch.column("values").flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        inside = (idx >= 0) & (idx < width)
        self.idx, self.val, self.row = idx[inside], val[inside], row[inside]
        self.rows, self.width = batch.num_rows, width

    def times(self, w: np.ndarray) -> np.ndarray:
        columns = [np.bincount(self.row, self.val * w[self.idx, k], self.rows) for k in range(w.shape[1])]
        return np.stack(columns, axis=1)

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        columns = [np.bincount(self.idx, self.val * r[self.row, k], self.width) for k in range(r.shape[1])]
        return np.stack(columns, axis=1)

    def squared_transposed_times(self, r: np.ndarray) -> np.ndarray:
        columns = [np.bincount(self.idx, self.val**2 * r[self.row, k], self.width) for k in range(r.shape[1])]
        return np.stack(columns, axis=1)

    def columns(self, low: int, high: int) -> np.ndarray:
        """A dense block of some features, from the entries that lie in it."""
        inside = (self.idx >= low) & (self.idx < high)
        at = self.row[inside] * (high - low) + self.idx[inside] - low
        return np.bincount(at, self.val[inside], self.rows * (high - low)).reshape(self.rows, high - low)


def feature_names(df: DataFrame) -> list[str]:
    if "features" in df.columns:
        return ["features"]
    if {"indices", "values"} <= set(df.columns):
        return ["indices", "values"]
    raise ValueError("rows need `features`, or `indices` and `values`")


def matrix(batch: pa.RecordBatch, width: int) -> Dense | Sparse:
    return Dense(batch, width) if "features" in batch.schema.names else Sparse(batch, width)


def feature_width(df: DataFrame) -> int:
    """Length of the dense arrays, or the largest feature id plus one; always taken from the training rows.

    Dense rows of another length raise when they are read as a matrix, so one row tells.
    """
    if "features" in df.columns:
        first = df.select(F.size("features")).head()
        return first[0] if first else 0
    return int(df.agg(F.max(F.array_max("indices") + 1)).head()[0] or 0)


def check_broadcast(size: int, what: str) -> None:
    if size > BROADCAST_BYTES:
        raise ValueError(f"{what} takes {size} bytes, more than the {BROADCAST_BYTES} that may be broadcast")


def sum_partials(
    df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], tuple[float, float, np.ndarray] | None], parts: int, size: int,
    driver_bytes: int = DRIVER_BYTES,
) -> tuple[float, float, np.ndarray]:
    """Run ``kernel`` once per task and add up what the tasks return: (loss, weight, array of ``size``).

    Rows never move: each task reduces its own rows to one array. When all arrays together would be too much for the
    driver (``driver_bytes``), they are cut into slices and added up by further tasks first, ``FAN_IN`` arrays at a time, so that no task
    reads more than so many slices of ``SLICE_VALUES`` however many tasks there were or however large the model is. Arrays
    are added in task order, so a result does not depend on which task ends first.
    """
    levels = max(1, driver_bytes // max(8 * size, 1))
    cuts = [*range(0, max(size, 1), SLICE_VALUES), size]

    def rows_of(part: int, loss: float, weight: float, total: np.ndarray):
        for slot, (low, high) in enumerate(zip(cuts, cuts[1:])):
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "slot": pa.array([slot], pa.int32()),
                 "loss": [0.0 if slot else float(loss)], "weight": [0.0 if slot else float(weight)],
                 "sums": [np.ascontiguousarray(total[low:high], dtype=np.float64).tobytes()]}
            )

    def reduce_task(batches):
        from pyspark import TaskContext

        result = kernel(batches)
        if result is not None:
            yield from rows_of(TaskContext.get().partitionId(), *result)

    def add_up(groups: int):
        def run(batches):
            held = None
            for batch in batches:  # sorted by slot, group and part
                for row in batch.to_pylist():
                    key, values = (row["slot"], row["part"] % groups), np.frombuffer(row["sums"])
                    if held is not None and held[0] == key:
                        held[1] += row["loss"]
                        held[2] += row["weight"]
                        held[3] += values
                        continue
                    if held is not None:
                        yield packed(held)
                    held = [key, row["loss"], row["weight"], values.copy()]
            if held is not None:
                yield packed(held)

        return run

    def packed(held) -> pa.RecordBatch:
        (slot, part), loss, weight, total = held
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "slot": pa.array([slot], pa.int32()), "loss": [loss],
             "weight": [weight], "sums": [total.tobytes()]}
        )

    partials = map_arrow(df, reduce_task, PARTIAL_SCHEMA)
    while parts > levels:
        parts = max(levels, -(-parts // FAN_IN))
        group = F.col("part") % F.lit(parts)
        met = partials.repartition(min(parts * (len(cuts) - 1), 4096), F.col("slot"), group)
        partials = met.sortWithinPartitions(F.col("slot"), group, F.col("part")).mapInArrow(add_up(parts), PARTIAL_SCHEMA)
    loss, weight, total = 0.0, 0.0, np.zeros(size)
    for row in sorted(partials.collect(), key=lambda r: (r["part"], r["slot"])):
        loss += row["loss"]
        weight += row["weight"]
        total[cuts[row["slot"]] : cuts[row["slot"] + 1]] += np.frombuffer(row["sums"])
    return loss, weight, total
