"""Gapless numbers inside groups of any size, without ever gathering a group."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.llm.batches import map_arrow, unused
from gradloom.llm.kernels import local_ranks
from gradloom.session import reliable_checkpoint


def number_in_groups(df: DataFrame, group: str, out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2, … inside every value of the integer column ``group``.

    Rows are checkpointed, so that each stays in its partition even when executors are lost. Every partition numbers its
    own rows, and only one count per (partition, group) is shuffled; a group that holds a third of all rows is
    spread over as many tasks as before. Groups must not be null.
    """
    return number_placed(reliable_checkpoint(df), group, out)


def number_placed(checkpointed: DataFrame, group: str, out: str) -> DataFrame:
    """``number_in_groups`` for a table that is checkpointed already."""
    part, local, start, n = unused(checkpointed, "_part", "_local", "_start", "_n")
    placed = checkpointed.withColumn(part, F.spark_partition_id())
    at = placed.columns.index(group)

    def rank(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            ranks = local_ranks(batch.column(at).to_numpy(zero_copy_only=False), seen)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ranks)], names=[*batch.schema.names, local]
            )

    counts = placed.groupBy(part, group).agg(F.count("*").alias(n))
    before = W.partitionBy(group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(part, group, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    ranked = map_arrow(placed, rank, T.StructType([*placed.schema.fields, T.StructField(local, T.LongType())]))
    return ranked.join(starts, [part, group]).withColumn(out, F.col(start) + F.col(local)).drop(part, local, start)
