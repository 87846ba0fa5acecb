"""Features from columns, arrays, triples, CSV files and stored feature tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.functions.vectors import typed_label
from gradloom.sources.textlines import with_row_id


def from_dense(
    df: DataFrame, feature_cols: Sequence[str] | str, row_id: str, label: str | None = None, label_type: str = "int"
) -> DataFrame:
    """Numeric columns, or one array column, as ``features array<double>``; labels as ``label_type``."""
    if isinstance(feature_cols, str):
        features = F.col(feature_cols).cast("array<double>")
    else:
        features = F.array(*[F.col(c).cast("double") for c in feature_cols])
    labels = [] if label is None else [typed_label(F.col(label), label_type).alias("label")]
    return df.select(F.col(row_id).cast("bigint").alias("row_id"), *labels, features.alias("features"))


def from_triples(triples: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``(row_id, col, value)`` entries as one sparse row each; ``rows`` names rows that may have no entry.

    Both inputs meet in a union, so one shuffle on ``row_id`` builds the arrays and keeps the empty rows.
    """
    entry = F.struct(F.col("col").cast("int").alias("i"), F.col("value").cast("double").alias("v"))
    entries = triples.select("row_id", entry.alias("entry"))
    if rows is not None:
        entries = entries.unionByName(rows.select("row_id", F.lit(None).cast("struct<i:int,v:double>").alias("entry")))
    packed = entries.groupBy("row_id").agg(F.sort_array(F.collect_list("entry")).alias("e"))
    return packed.select("row_id", F.col("e.i").alias("indices"), F.col("e.v").alias("values"))


def read_csv_features(
    spark: SparkSession,
    path: str,
    schema: str,
    label: str,
    separator: str = ",",
    header: bool = True,
    ignore: Sequence[str] = (),
    id: str | None = None,
    label_offset: int = 0,
    label_type: str = "int",
) -> DataFrame:
    """CSV rows with an explicit schema, the label shifted and named ``label`` (as ``label_type``), the id named ``row_id``.

    Without an id, rows are numbered by file and place in the file, as those of other sources are.
    """
    rows = spark.read.csv(path, schema=schema, sep=separator, header=header, mode="FAILFAST")
    if id is None and "row_id" not in rows.columns:
        held = rows.select(
            F.struct(*rows.columns).alias("_row"), F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"),
        )
        rows = with_row_id(held).select("row_id", "_row.*")
    rows = offset_label(drop_ignored(rows, ignore).withColumnRenamed(label, "label"), label_offset, label_type)
    return keep_id(rows, id) if id else rows


def drop_ignored(df: DataFrame, ignore: Sequence[str]) -> DataFrame:
    return df.drop(*ignore)


def keep_id(df: DataFrame, id: str) -> DataFrame:
    """Carry the identifier first, as ``row_id``; it is no feature."""
    return df.select(F.col(id).alias("row_id"), *[c for c in df.columns if c != id])


def offset_label(df: DataFrame, label_offset: int, label_type: str = "int") -> DataFrame:
    return df.withColumn("label", typed_label(F.col("label") + F.lit(label_offset), label_type))


def with_targets(df: DataFrame, *columns: str) -> DataFrame:
    """``targets array<double>`` for regression from one or more columns, by default from ``label``."""
    return df.withColumn("targets", F.array(*[F.col(c).cast("double") for c in columns or ("label",)]))


def materialize_features(df: DataFrame, path: str) -> DataFrame:
    """Write parsed features once as Parquet, replacing what is there with a warning, and read them back."""
    spark = df.sparkSession
    try:
        spark.read.parquet(path)
    except AnalysisException:
        pass
    else:
        warnings.warn(f"{path} exists and is overwritten", stacklevel=2)
    df.write.mode("overwrite").parquet(path)
    return read_features(spark, path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
