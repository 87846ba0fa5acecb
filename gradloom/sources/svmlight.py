"""Sparse text rows: ``label idx:val idx:val``, 0-based unless told otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.functions.vectors import format_value, sparse_to_text, typed_label
from gradloom.sources.textlines import read_lines, with_row_id


def _entries(df: DataFrame, tokens: str, base: int) -> DataFrame:
    index = F.transform(tokens, lambda t: F.substring_index(t, ":", 1).cast("int") - base)
    value = F.transform(tokens, lambda t: F.substring_index(t, ":", -1).cast("double"))
    return df.withColumn("indices", index).withColumn("values", value)


def _tokens():
    return F.filter(F.split(F.replace(_body(), F.lit("\t"), F.lit(" ")), " "), lambda t: t != "")


def _body():
    return F.trim(F.substring_index("value", "#", 1))


def read_svmlight(spark: SparkSession, path: str, zero_based: bool = True, label_type: str = "int") -> DataFrame:
    """Labelled rows. A line with a label only is an all-zero row; blank lines and comments are no rows.

    ``label_type="double"`` keeps labels as they stand in the file; with ``int`` a label like 2.7 raises.
    """
    lines = with_row_id(read_lines(spark, path, keep=F.replace(_body(), F.lit("\t"), F.lit("")) != "")).withColumn("_tokens", _tokens())
    label = typed_label(F.get("_tokens", F.lit(0)).cast("double"), label_type)
    rows = lines.withColumn("label", label).withColumn("_tokens", F.slice("_tokens", 2, F.greatest(F.size("_tokens"), F.lit(1))))
    rows = _entries(rows, "_tokens", 0 if zero_based else 1)
    return rows.select("row_id", "label", "indices", "values")


def read_svmlight_unlabelled(spark: SparkSession, path: str, zero_based: bool = True) -> DataFrame:
    """Rows to score. An empty line is an all-zero row and keeps its number."""
    lines = with_row_id(read_lines(spark, path).withColumn("_tokens", _tokens()))
    return _entries(lines, "_tokens", 0 if zero_based else 1).select("row_id", "indices", "values")


def svmlight_lines(df: DataFrame, labelled: bool = True):
    body = sparse_to_text()
    if not labelled:
        return df.select(body.alias("value"))
    return df.select(F.rtrim(F.concat_ws(" ", format_value(F.col("label")), body)).alias("value"))


def write_svmlight(df: DataFrame, path: str, labelled: bool = True, mode: str = "errorifexists") -> None:
    """Write ``label``/``indices``/``values`` rows as text, one file per partition."""
    svmlight_lines(df, labelled).write.mode(mode).text(path)
