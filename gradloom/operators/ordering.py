"""Row numbers and prefix sums that never sort the whole table in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.functions.hashing import seeded_md5
from gradloom.functions.vectors import constant_array
from gradloom.session import map_arrow, reliable_checkpoint

# Rows that one hash bucket should hold at most; buckets are cut by so many leading hex digits of the hash.
BUCKET_ROWS = 100_000


def prefix_sum(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows that come earlier in ``keys`` order.

    Rows are range-partitioned, sorted and checkpointed, so that the place of a row stays fixed even when executors are
    lost; a second pass adds up each range from where the ranges before it end, without another exchange. ``keys``
    must be unique per row, which keeps ranges even. Nulls count as 0.
    """
    ranged = reliable_checkpoint(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    sums = ranged.groupBy(F.spark_partition_id().alias("range")).agg(F.coalesce(F.sum(value), F.lit(0)).alias("total"))
    starts, start = {}, 0
    for row in sorted(sums.collect(), key=lambda r: r["range"]):  # one row per partition
        starts[row["range"]] = start
        start += row["total"]
    whole = isinstance(ranged.schema[value].dataType, T.IntegralType)
    at = ranged.columns.index(value)

    def add_up(batches):
        from pyspark import TaskContext

        held = starts.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            values = np.nan_to_num(batch.column(at).to_numpy(zero_copy_only=False), nan=0.0) if batch.column(at).null_count else batch.column(at).to_numpy()
            ends = held + np.cumsum(values, dtype=np.int64 if whole else np.float64)
            before = np.concatenate([[held], ends[:-1]]).astype(ends.dtype) if len(ends) else ends
            held = ends[-1].item() if len(ends) else held
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, out])

    kind = T.LongType() if whole else T.DoubleType()
    return map_arrow(ranged, add_up, T.StructType([*ranged.schema.fields, T.StructField(out, kind)]))


def dense_positions(df: DataFrame, keys: Sequence[str], out: str = "position") -> DataFrame:
    """Number distinct rows 0, 1, 2, … in ``keys`` order."""
    counted = prefix_sum(df.withColumn("_one", F.lit(1).cast("bigint")), keys, "_one", out)
    return counted.drop("_one")


def number_by_hash(
    df: DataFrame,
    seed: int,
    row_id: str = "row_id",
    out: str = "position",
    wanted: Sequence[tuple[int, int]] | None = None,
) -> DataFrame:
    """Position of every row in the seeded hash order of its id.

    The hash is uniform, so its leading digits cut the table into even buckets of some ``BUCKET_ROWS`` rows, however many
    rows there are; bucket sizes are counted first and rows are then ranked inside their bucket only. With ``wanted``
    position ranges [low, high), buckets outside of them are left out before anything is shuffled.
    """
    hashed, starts = _bucketed(df.withColumn("_hash", seeded_md5(seed, F.col(row_id))))
    buckets = len(starts) - 1
    if wanted is not None:
        touched = [b for b in range(buckets) if any(starts[b] < high and starts[b + 1] > low for low, high in wanted)]
        if len(touched) < buckets:
            member = set(touched)
            flags = constant_array([int(b in member) for b in range(buckets)], "int")
            hashed = hashed.where(F.get(flags, F.col("_bucket")) == 1)
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy("_hash", row_id))
    placed = hashed.withColumn(out, F.get(constant_array(starts, "bigint"), F.col("_bucket")) + rank - 1)
    if wanted is not None:
        inside = F.lit(False)
        for low, high in wanted:
            inside |= F.col(out).between(low, high - 1)
        placed = placed.where(inside)
    return placed.drop("_hash", "_bucket")


def _bucketed(hashed: DataFrame) -> tuple[DataFrame, list[int]]:
    """Rows with their ``_bucket``; the first position of every bucket, and the number of rows at the end.

    One small row per bucket reaches the driver: one per ``BUCKET_ROWS`` rows of the table.
    """
    digits = max(1, math.ceil(math.log(max(hashed.count() / BUCKET_ROWS, 1), 16)))
    cut = hashed.withColumn("_bucket", F.conv(F.substring("_hash", 1, digits), 16, 10).cast("int"))
    counts = {r["_bucket"]: r["count"] for r in cut.groupBy("_bucket").count().collect()}
    starts = [0]
    for bucket in range(16**digits):
        starts.append(starts[-1] + counts.get(bucket, 0))
    return cut, starts


def before_hash_position(df: DataFrame, seed: int, place: int, row_id: str = "row_id") -> Column:
    """Whether a row comes before position ``place`` in hash order.

    Only the one bucket that holds the position is ranked; all other rows are told apart by their hash.
    """
    hashed, starts = _bucketed(df.select(row_id, seeded_md5(seed, F.col(row_id)).alias("_hash")))
    if place >= starts[-1]:
        return F.lit(True)
    bucket = max(b for b in range(len(starts) - 1) if starts[b] <= place < starts[b + 1])
    ranked = dense_positions(hashed.where(F.col("_bucket") == bucket).select("_hash", row_id), ["_hash", row_id])
    edge = ranked.where(F.col("position") == place - starts[bucket]).head()
    own = seeded_md5(seed, F.col(row_id))
    return (own < edge["_hash"]) | ((own == edge["_hash"]) & (F.col(row_id) < F.lit(edge[row_id])))


def kth_smallest(df: DataFrame, column: str, k: int):
    """The value at position k (from 0) of a unique numeric column, or None beyond its end.

    A quantile sketch names a narrow range around it; only the values in that range are ranked.
    """
    rows = df.count()
    if k >= rows:
        return None
    around = [max(0.0, k / rows - 0.01), min(1.0, (k + 1) / rows + 0.01)]
    low, high = df.agg(F.percentile_approx(column, around, F.lit(1000))).head()[0]
    below = df.where(F.col(column) < F.lit(low)).count()
    inside = df.where(F.col(column).between(F.lit(low), F.lit(high))).select(column)
    if not below <= k < below + inside.count():
        inside, below = df.select(column), 0
    return dense_positions(inside, [column]).where(F.col("position") == k - below).head()[column]


def shuffle_rows(df: DataFrame, seed: int, row_id: str = "row_id") -> DataFrame:
    """Rows in seeded hash order; seed -1 draws a new order each time."""
    if seed == -1:
        return df.orderBy(F.rand())
    return df.orderBy(seeded_md5(seed, F.col(row_id)), row_id)


def earlier_max(
    df: DataFrame, group: str, order: Sequence[str], value: str, segment: Column, out: str
) -> DataFrame:
    """Largest ``value`` among all earlier rows of the same group; null on the first row.

    A group may hold a third of the table, so it is cut into segments that follow its order. Segment maxima are
    one small row each; a running maximum over those is joined to a running maximum inside every segment.
    ``segment`` must not decrease along ``order``.
    """
    cut = df.withColumn("_segment", segment)
    maxima = cut.groupBy(group, "_segment").agg(F.max(value).alias("_peak"))
    earlier_segments = W.partitionBy(group).orderBy("_segment").rowsBetween(W.unboundedPreceding, -1)
    carried = maxima.select(group, "_segment", F.max("_peak").over(earlier_segments).alias("_carried"))
    inside = W.partitionBy(group, "_segment").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        cut.join(carried, [group, "_segment"])
        .withColumn(out, F.greatest(F.max(value).over(inside), "_carried"))
        .drop("_segment", "_carried")
    )
