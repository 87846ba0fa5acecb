"""Column expressions over feature vectors, sparse text and score arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.session import map_arrow


def constant_array(values: Sequence, element: str) -> Column:
    """A literal array from one string; Spark folds it once, however long it is."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{element}>")


def dense_to_sparse(df: DataFrame, features: str = "features") -> DataFrame:
    """Replace a dense array by ``indices``/``values``: zeros (also -0.0) go, NaN stays."""
    entries = F.filter(
        F.transform(F.col(features), lambda v, i: F.struct(i.alias("i"), v.cast("double").alias("v"))),
        lambda e: e["v"] != F.lit(0.0),
    )
    return (
        df.withColumn("_entries", entries)
        .withColumn("indices", F.col("_entries.i"))
        .withColumn("values", F.col("_entries.v"))
        .drop("_entries", features)
    )


def sparse_to_dense(df: DataFrame, width: int, out: str = "features") -> DataFrame:
    """Dense array of ``width`` values; ids at or beyond the width are left out, absent ids are 0.

    Repeated ids add up, as they do in a product with weights. Whole batches are scattered at once.
    """
    kept = [c for c in df.columns if c not in ("indices", "values", out)]

    def scatter(batches):
        for batch in batches:
            lists = batch.column("indices")
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            values = np.asarray(batch.column("values").flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            inside = (ids >= 0) & (ids < width)
            dense = np.zeros(batch.num_rows * width)
            np.add.at(dense, rows[inside] * width + ids[inside], values[inside])
            offsets = pa.array((np.arange(batch.num_rows + 1) * width).astype(np.int32))
            packed = pa.ListArray.from_arrays(offsets, pa.array(dense))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], packed], names=[*kept, out])

    schema = T.StructType([df.schema[c] for c in kept]).add(out, T.ArrayType(T.DoubleType()))
    return map_arrow(df.select(*kept, "indices", "values"), scatter, schema)


def format_value(value: Column) -> Column:
    """Shortest text that reads back as the same double."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def format_value_16g(value: Column) -> Column:
    """``%.16g`` text, for files that must match other svmlight writers byte by byte."""

    def write(values: pd.Series) -> pd.Series:
        return values.map("{:.16g}".format)

    return F.pandas_udf(write, T.StringType())(value)


def sparse_to_text(indices: str = "indices", values: str = "values") -> Column:
    """``idx:val idx:val``; explicit zeros and repeated entries are written as they are."""
    entries = F.zip_with(indices, values, lambda i, v: F.concat(i.cast("string"), F.lit(":"), v.cast("string")))
    # As ``format_value``, at once for all values of a row.
    line = F.concat(F.array_join(entries, " "), F.lit(" "))
    return F.rtrim(F.replace(line, F.lit(".0 "), F.lit(" ")))


def typed_label(label: Column, kind: str = "int") -> Column:
    """A label as ``kind``. Whole-number kinds take whole numbers only; anything else raises instead of being cut."""
    if kind in ("double", "float"):
        return label.cast(kind)
    whole = label.cast("double")
    told = F.concat(F.lit("label "), label.cast("string"), F.lit(f" is no {kind}; read it with label_type='double'"))
    return F.when(whole.isNull() | (whole == F.floor(whole)), whole.cast(kind)).otherwise(F.raise_error(told).cast(kind))


def predicted_class(scores: Column | str) -> Column:
    """Position of the largest score; ties and all-zero rows go to the lowest class."""
    scores = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def class_weight(label: Column, weights: Sequence[float] | None, nclasses: int) -> Column:
    """Weight of a row by its class; every class weighs 1 unless weights are given."""
    weights = [1.0] * nclasses if weights is None else [float(w) for w in weights]
    if len(weights) != nclasses:
        raise ValueError(f"{len(weights)} class weights for {nclasses} classes")
    return F.element_at(F.array(*[F.lit(w) for w in weights]), label + 1)
