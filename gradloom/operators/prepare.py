"""Scaling, categorical encoding, splitting and batching of feature tables."""

from __future__ import annotations

import secrets

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradloom.functions.hashing import hash_thousandth
from gradloom.functions.vectors import constant_array
from gradloom.operators.ordering import before_hash_position, dense_positions, kth_smallest, number_by_hash
from gradloom.session import shipped_if_small


# Bytes of a category in a join besides its value.
CATEGORY_BYTES = 40


@dataclass(frozen=True)
class StandardScaler:
    """Column means and population deviations of an array of features; one number per feature."""

    means: list[float]
    deviations: list[float]

    @staticmethod
    def statistics(df: DataFrame, features: str = "features") -> DataFrame:
        """``feature``, ``mean``, ``deviation``; partial sums are kept per feature before the shuffle."""
        entries = df.select(F.posexplode(features).alias("feature", "value"))
        return entries.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))

    @classmethod
    def fit(cls, df: DataFrame, features: str = "features") -> StandardScaler:
        rows = sorted(cls.statistics(df, features).collect())  # one row per feature
        return cls([r["mean"] for r in rows], [r["deviation"] for r in rows])

    def apply(self, df: DataFrame, features: str = "features") -> DataFrame:
        """(x - mean) / deviation; a constant column is only centred."""
        mean = constant_array(self.means, "double")
        divisor = constant_array([d if d else 1.0 for d in self.deviations], "double")
        scaled = F.transform(F.col(features), lambda v, i: (v - F.get(mean, i)) / F.get(divisor, i))
        return df.withColumn(features, scaled)


def train_test_split(df: DataFrame, test_size: float, seed: int, row_id: str = "row_id") -> DataFrame:
    """Tag rows ``train`` or ``test`` by a seeded hash of the id; no shuffle, same split under any partitioning."""
    held_out = hash_thousandth(seed, F.col(row_id)) < F.lit(round(test_size * 1000))
    return df.withColumn("split", F.when(held_out, F.lit("test")).otherwise(F.lit("train")))


def validation_bundle(validation: Sequence[DataFrame]) -> DataFrame | None:
    """Validation sets as one table, tagged ``val_1``, ``val_2``, … in ``split``."""
    tagged = [v.withColumn("split", F.lit(f"val_{i}")) for i, v in enumerate(validation, 1)]
    return reduce(DataFrame.unionByName, tagged) if tagged else None


def dataset_bundle(train: DataFrame, validation: Sequence[DataFrame] = ()) -> DataFrame:
    """The training set followed by its validation sets, told apart by ``split``."""
    tagged, checks = train.withColumn("split", F.lit("train")), validation_bundle(validation)
    return tagged if checks is None else tagged.unionByName(checks)


def minmax_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: ``column``, ``low``, ``high``; a single aggregation pass."""
    bounds = df.agg(
        *[F.min(c).cast("double").alias(f"low_{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("double").alias(f"high_{i}") for i, c in enumerate(columns)],
    )
    triples = [F.struct(F.lit(c).alias("column"), F.col(f"low_{i}").alias("low"), F.col(f"high_{i}").alias("high"))
               for i, c in enumerate(columns)]
    return bounds.select(F.inline(F.array(*triples)))


def minmax_apply(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale columns to [0, 1] by given bounds; a column with one value becomes 0."""
    scaled = {
        c: F.lit(0.0) if high == low else (F.col(c) - F.lit(float(low))) / F.lit(float(high - low))
        for c, (low, high) in bounds.items()
    }
    return df.withColumns(scaled)


def bounds_of(fitted: DataFrame) -> dict[str, tuple[float, float]]:
    """The fitted bounds as ``{column: (low, high)}``; one entry per column."""
    return {r["column"]: (r["low"], r["high"]) for r in fitted.collect()}


def categorical_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column``, ``value``, ``position``: every value's place in its column's sorted value list."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    numbered = dense_positions(values, ["column", "value"], "place")
    starts = numbered.groupBy("column").agg(F.min("place").alias("start"))
    return numbered.join(F.broadcast(starts), "column").select(  # one row per encoded column
        "column", "value", (F.col("place") - F.col("start")).cast("int").alias("position")
    )


def categorical_apply(df: DataFrame, mapping: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-hot arrays under the old names; a value the mapping lacks becomes all zeros."""
    widths, sizes = _category_counts(mapping)
    for c in columns:
        width = widths.get(c, 0)
        codes = mapping.where(F.col("column") == c).select(F.col("value").alias(c), F.col("position").alias("_code"))
        codes = shipped_if_small(codes, sizes.get(c, 0))
        one_hot = F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)) if width else F.array().cast("array<int>"),
            lambda i: F.when(i == F.col("_code"), 1.0).otherwise(0.0),
        )
        df = df.withColumn(c, F.col(c).cast("string")).join(codes, c, "left").withColumn(c, one_hot).drop("_code")
    return df


def _category_counts(mapping: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """Categories of each column, and the bytes they take in a join; one row per column."""
    size = F.sum(F.octet_length("value") + CATEGORY_BYTES)
    rows = mapping.groupBy("column").agg(F.count("*").alias("n"), size.alias("size")).collect()
    return {r["column"]: r["n"] for r in rows}, {r["column"]: r["size"] for r in rows}


def categorical_entries(df: DataFrame, mapping: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as one sparse row (``indices``, ``values``): one entry per column, whatever the number of its categories.

    Categories of the first column have ids from 0, those of the next one follow. A value that the mapping lacks has no entry.
    """
    widths, sizes = _category_counts(mapping)
    start, codes = 0, []
    for i, c in enumerate(columns):
        places = mapping.where(F.col("column") == c).select(F.col("value").alias(c), (F.col("position") + start).alias(f"_code{i}"))
        df = df.withColumn(c, F.col(c).cast("string")).join(shipped_if_small(places, sizes.get(c, 0)), c, "left")
        codes.append(f"_code{i}")
        start += widths.get(c, 0)
    indices = F.array_compact(F.array(*codes))
    return df.withColumn("indices", indices).withColumn("values", F.transform("indices", lambda _: F.lit(1.0))).drop(*codes, *columns)


def csv_test_split(
    df: DataFrame, test_split: float, shuffle: bool = False, seed: int = 0, row_id: str = "row_id"
) -> DataFrame:
    """Hold out the last fraction of the rows, in seeded hash order if ``shuffle``, else in id order.

    Seed -1 draws another order each time.

    Rows are not moved: the id (or hash) at the cut is found first, and every row is compared with it.
    """
    cut = int(df.count() * (1 - test_split) + 1e-9)
    if shuffle:
        seed = secrets.randbelow(2**31) if seed == -1 else seed
        kept = before_hash_position(df, seed, cut, row_id)
    else:
        edge = kth_smallest(df, row_id, cut)
        kept = F.lit(True) if edge is None else F.col(row_id) < F.lit(edge)
    return df.withColumn("split", F.when(kept, F.lit("train")).otherwise(F.lit("test")))


def assign_minibatch(
    df: DataFrame, batch_size: int, iter_size: int = 1, seed: int = 0, row_id: str = "row_id"
) -> DataFrame:
    """``batch_id`` of every row: ``batch_size * iter_size`` rows at a time in seeded hash order."""
    placed = number_by_hash(df, seed, row_id, "_place")
    return placed.withColumn("batch_id", F.floor(F.col("_place") / F.lit(batch_size * iter_size))).drop("_place")


def mark_smoothed(df: DataFrame, group: str, order: str, value: str, last: int, segment: Column, out: str) -> DataFrame:
    """Mean of the last ``last`` values of a group, this row included, in ``order``.

    Long groups are cut into segments. Each segment's closing rows travel to the segments that need them, so no
    window ever spans a whole group.
    """
    cut = df.withColumn("_segment", segment)
    if last <= 1:
        return cut.withColumn(out, F.col(value)).drop("_segment")
    point = F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
    from_end = F.row_number().over(W.partitionBy(group, "_segment").orderBy(F.desc(order)))
    tails = (
        cut.withColumn("_back", from_end)
        .where(F.col("_back") < last)
        .groupBy(group, "_segment")
        .agg(F.sort_array(F.collect_list(point)).alias("tail"))  # at most last - 1 points
    )
    earlier = W.partitionBy(group).orderBy("_segment").rowsBetween(-(last - 1), -1)
    carried = tails.select(
        group, "_segment", F.sort_array(F.flatten(F.collect_list("tail").over(earlier))).alias("points")
    ).select(
        group,
        "_segment",
        F.inline(F.slice("points", F.greatest(F.size("points") - (last - 2), F.lit(1)), last - 1)),
    )
    carried = carried.select(group, "_segment", F.col("o").alias(order), F.col("v").alias(value)).withColumn(
        "_carried", F.lit(True)
    )
    together = cut.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    recent = W.partitionBy(group, "_segment").orderBy(order).rowsBetween(-(last - 1), 0)
    return together.withColumn(out, F.avg(value).over(recent)).where(~F.col("_carried")).drop("_segment", "_carried")
