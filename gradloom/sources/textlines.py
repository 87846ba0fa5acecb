"""Text files as numbered lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom import session
from gradloom.operators.ordering import prefix_sum
from gradloom.session import local_table, reliable_checkpoint

# Splits whose counts are added up on the driver; those of more are added up where they lie.
DRIVER_SPLITS = 10_000
# Bytes of a row of the split table besides its path.
SPLIT_BYTES = 40


def read_lines(
    spark: SparkSession, path: str, glob: str | None = None, keep: Column | None = None, nested: bool = False
) -> DataFrame:
    """``value``, ``file_path``, ``block`` and a sequence that counts the kept lines along each file split.

    With ``nested`` files of folders below ``path`` belong to it, whatever the folders' names.
    """
    reader = spark.read.option("recursiveFileLookup", nested)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path)
    return (lines if keep is None else lines.where(keep)).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def with_row_id(
    lines: DataFrame,
    out: str = "row_id",
    group: Callable[[Column], Column] | None = None,
    order: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Number lines 0, 1, 2, … by file path and place in the file.

    ``order`` gives files another order than that of their paths, equal ones going by path. With ``group`` numbers start
    afresh for every value it takes from a path.

    The first pass counts lines per file split. Up to ``DRIVER_SPLITS`` counts are added up on the driver, more by a
    distributed prefix sum. The second pass adds the split's offset to the place inside the split. No line moves
    as long as the split table can be broadcast (``BROADCAST_BYTES``, checked: some two million splits).
    """
    splits = lines.groupBy("file_path", "block").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    path = F.col("file_path")
    keyed = splits.withColumn("_group", F.lit("") if group is None else group(path)).withColumn(
        "_order", F.lit("") if order is None else order(path)
    )
    few = keyed.limit(DRIVER_SPLITS + 1).collect()
    table = _added_up(lines.sparkSession, few) if len(few) <= DRIVER_SPLITS else _prefix_sums(keyed, group is not None)
    place = F.col("seq") - F.col("first_seq")
    moved = F.raise_error(F.lit("file splits changed between counting and numbering; read the files again"))
    return (
        lines.join(table, ["file_path", "block"], "left")
        .withColumn(out, F.when(place.between(0, F.col("n") - 1), F.col("seq") + F.col("shift")).otherwise(moved))
        .drop("block", "seq", "shift", "first_seq", "n")
    )


def _added_up(spark: SparkSession, splits: list) -> DataFrame:
    offsets, start, previous = [], 0, None
    for row in sorted(splits, key=lambda r: (r["_group"], r["_order"], r["file_path"], r["block"])):
        if row["_group"] != previous:
            start, previous = 0, row["_group"]
        offsets.append((row["file_path"], row["block"], start - row["first_seq"], row["first_seq"], row["n"]))
        start += row["n"]
    return F.broadcast(local_table(spark, offsets, "file_path string, block bigint, shift bigint, first_seq bigint, n bigint"))


def _prefix_sums(keyed: DataFrame, grouped: bool) -> DataFrame:
    summed = prefix_sum(keyed, ["_group", "_order", "file_path", "block"], "n", "_before")
    if grouped:
        starts = summed.groupBy("_group").agg(F.min("_before").alias("_start"))
        summed = summed.join(starts, "_group").withColumn("_before", F.col("_before") - F.col("_start"))
    shift = (F.col("_before") - F.col("first_seq")).alias("shift")
    table = reliable_checkpoint(summed.select("file_path", "block", shift, "first_seq", "n"))
    size = table.agg(F.sum(F.octet_length("file_path") + SPLIT_BYTES)).head()[0]
    return F.broadcast(table) if size <= session.BROADCAST_BYTES else table
