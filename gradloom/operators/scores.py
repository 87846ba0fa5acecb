"""From long class probabilities to dense score rows, best classes and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scatter_scores(long: DataFrame, nclasses: int, rows: DataFrame | None = None) -> DataFrame:
    """``row_id``, ``scores``: one slot per class, 0 where a class is absent. A repeated class raises.

    ``rows`` names rows that may have no entry; they get zeros. Entries and rows meet in one shuffle. Sorted entries are
    walked once per row: each appends the zeros before it and itself.
    """
    entries = long.select("row_id", F.struct(F.col("cat").cast("int").alias("cat"), F.col("prob").cast("double").alias("prob")).alias("e"))
    if rows is not None:
        entries = entries.unionByName(rows.select("row_id", F.lit(None).cast("struct<cat:int,prob:double>").alias("e")))
    inside = F.filter(F.sort_array(F.collect_list("e")), lambda e: e["cat"].between(0, nclasses - 1))
    twice = F.raise_error(F.lit("a class is repeated in a row"))
    scattered = F.aggregate(
        "_e",
        F.array().cast("array<double>"),
        lambda done, e: F.when(
            e["cat"] >= F.size(done),
            F.concat(done, F.array_repeat(F.lit(0.0), e["cat"] - F.size(done)), F.array(e["prob"])),
        ).otherwise(twice.cast("array<double>")),
        lambda done: F.concat(done, F.array_repeat(F.lit(0.0), F.lit(nclasses) - F.size(done))),
    )
    return entries.groupBy("row_id").agg(inside.alias("_e")).select("row_id", scattered.alias("scores"))


def long_scores(df: DataFrame, scores: str = "scores") -> DataFrame:
    """``row_id``, ``cat``, ``prob`` rows of a table of score arrays."""
    return df.select("row_id", F.posexplode(scores).alias("cat", "prob"))


def best_n_scores(df: DataFrame, n: int, scores: str = "scores") -> DataFrame:
    """``best_n`` straight from score arrays: each array is sorted in place and nothing is shuffled."""
    entries = F.transform(scores, lambda p, k: F.struct((-p).alias("below"), k.alias("cat"), p.alias("prob")))
    ordered = F.array_sort(entries)
    chosen = ordered if n == -1 else F.slice(ordered, 1, n)
    return df.select("row_id", F.posexplode(chosen).alias("place", "e")).select(
        "row_id", "e.cat", "e.prob", (F.col("place") + 1).alias("place")
    )


def best_n(long: DataFrame, n: int) -> DataFrame:
    """The n most probable classes of every row, ties to the lower class; -1 keeps all."""
    ranked = F.row_number().over(W.partitionBy("row_id").orderBy(F.desc("prob"), "cat"))
    placed = long.withColumn("place", ranked)
    return placed if n == -1 else placed.where(F.col("place") <= n)
