"""Feature vocabularies: dense positions for the feature ids (or words) seen in training."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.operators.ordering import dense_positions
from gradloom.session import BROADCAST_ROWS, map_arrow, reliable_checkpoint
from gradloom.sources.tables import from_triples


def feature_vocabulary(df: DataFrame) -> DataFrame:
    """``feature``, ``position``: distinct feature ids, numbered in ascending order."""
    ids = df.select(F.explode("indices").alias("feature")).distinct()
    return dense_positions(ids, ["feature"])


def apply_vocabulary(df: DataFrame, vocabulary: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Replace feature ids by vocabulary positions, in their order, and leave unknown ids out.

    A vocabulary of checked size travels to the executors and rows stay where they are. A larger one is joined
    by id; a feature that most rows carry is then split by the adaptive skew join. Both ways give the same rows, whether
    row ids are unique or not.
    """
    if vocabulary.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return _apply_in_place(df, vocabulary)
    # Checkpointed, so that a row keeps its number while its entries are away.
    held = reliable_checkpoint(df.withColumn("_row", F.monotonically_increasing_id()))
    entries = held.select("_row", F.inline(F.arrays_zip("indices", "values"))).withColumnRenamed("indices", "feature")
    known = entries.join(vocabulary, "feature").select(
        F.col("_row").alias("row_id"), F.col("position").alias("col"), F.col("values").alias("value")
    )
    packed = from_triples(known, held.select(F.col("_row").alias("row_id"))).withColumnRenamed("row_id", "_row")
    return held.drop("indices", "values").join(packed, "_row").select(*df.columns)


def _apply_in_place(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    known = np.array([r[0] for r in vocabulary.select("feature").orderBy("position").collect()], dtype=np.int64)
    shipped = df.sparkSession.sparkContext.broadcast(known)

    def translate(batches):
        ids = shipped.value
        for batch in batches:
            entries = batch.column("indices")
            flat = entries.flatten().to_numpy(zero_copy_only=False)
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            lengths = entries.value_lengths().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(batch.num_rows), lengths)
            place = np.searchsorted(ids, flat)
            kept = np.zeros(len(flat), dtype=bool)
            inside = place < len(ids)
            kept[inside] = ids[place[inside]] == flat[inside]
            rows, place, values = rows[kept], place[kept], np.asarray(values, np.float64)[kept]
            order = np.lexsort((values, place, rows))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))])
            offsets = pa.array(offsets.astype(np.int32))
            columns = {
                "indices": pa.ListArray.from_arrays(offsets, pa.array(place[order].astype(np.int32))),
                "values": pa.ListArray.from_arrays(offsets, pa.array(values[order])),
            }
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([columns.get(n, batch.column(n)) for n in names], names=names)

    return map_arrow(df, translate, df.schema)


# Largest vocabulary of words that is shipped, by the bytes of its words.
BROADCAST_WORD_BYTES = 64 * 1024 * 1024


def text_features(
    df: DataFrame, text: str = "text", row_id: str = "row_id", broadcast_bytes: int = BROADCAST_WORD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Bag of words: sparse word counts of every text, and the word vocabulary behind them.

    A text is one row, so its words are counted where it lies; only the distinct words of a batch of texts leave it, for the
    vocabulary. Words then meet their positions in place if the vocabulary is small enough to travel, else by a join that
    splits a word found in every text. Both ways give entries in the order of positions.
    """
    rows = df.select(F.col(row_id).alias("row_id"), F.coalesce(F.lower(text), F.lit("")).alias("text"))
    words = map_arrow(rows.select("text"), _distinct_words, "feature string").distinct()
    vocabulary = dense_positions(words, ["feature"])
    size = vocabulary.agg(F.sum(F.octet_length("feature") + 8)).head()[0] or 0
    row_ids = T.StructType([rows.schema["row_id"]])
    if size <= broadcast_bytes:
        known = pa.array([r[0] for r in vocabulary.select("feature").orderBy("position").collect()], pa.string())
        shipped = df.sparkSession.sparkContext.broadcast(known)

        def translate(batches):
            for batch in batches:
                lists, coded = _coded_words(batch)
                found = pc.index_in(coded.dictionary, shipped.value).to_numpy(zero_copy_only=False)
                offsets, place, counts = _counted(lists, found[coded.indices.to_numpy(zero_copy_only=False)], max(len(shipped.value), 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_id"), *(pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (place.astype(np.int32), counts))],
                    names=["row_id", "indices", "values"],
                )

        schema = row_ids.add("indices", T.ArrayType(T.IntegerType())).add("values", T.ArrayType(T.DoubleType()))
        return map_arrow(rows, translate, schema), vocabulary
    counted = map_arrow(rows, _count_words, row_ids.add("words", T.ArrayType(T.StringType())).add("values", T.ArrayType(T.DoubleType())))
    entries = counted.select("row_id", F.inline(F.arrays_zip("words", "values"))).withColumnRenamed("words", "feature")
    entries = entries.join(vocabulary, "feature").select("row_id", F.col("position").alias("col"), F.col("values").alias("value"))
    return from_triples(entries, counted.select("row_id")), vocabulary


def _coded_words(batch):
    """The words of every text of a batch as lists, and all of them in a row as codes of distinct ones."""
    texts = batch.column("text")
    for blank in "\t\r\n":
        texts = pc.replace_substring(texts, blank, " ")
    lists = pc.split_pattern(texts, " ")
    flat = lists.flatten()
    filled = pc.not_equal(flat, "")
    ends = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    flat = flat.filter(filled)
    return pa.ListArray.from_arrays(pa.array(ends[starts].astype(np.int32)), flat), flat.dictionary_encode()


def _counted(lists, codes, width):
    """Distinct codes of every list in their order, how often each stands there, and the bounds of the lists."""
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    keys, counts = np.unique(rows * width + codes.astype(np.int64), return_counts=True)
    offsets = pa.array(np.searchsorted(keys, np.arange(len(lists) + 1) * width).astype(np.int32))
    return offsets, keys % width, counts.astype(np.float64)


def _distinct_words(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([_coded_words(batch)[1].dictionary], names=["feature"])


def _count_words(batches):
    """Distinct words of every row and how often each stands there."""
    for batch in batches:
        lists, coded = _coded_words(batch)
        offsets, codes, counts = _counted(lists, coded.indices.to_numpy(zero_copy_only=False), max(len(coded.dictionary), 1))
        words = coded.dictionary.take(pa.array(codes))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, pa.array(counts))],
            names=["row_id", "words", "values"],
        )
