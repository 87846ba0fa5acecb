"""Queries over sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradloom.functions.vectors import dense_to_sparse
from gradloom.operators.prepare import csv_test_split, dataset_bundle
from gradloom.operators.vocabulary import apply_vocabulary, feature_vocabulary
from gradloom.session import scratch_path
from gradloom.sources.journals import read_call_history, read_run_logs
from gradloom.sources.svmlight import read_svmlight, read_svmlight_unlabelled, write_svmlight
from gradloom.sources.tables import from_dense, from_triples, materialize_features, read_csv_features
from gradloom.streaming.growing import stream_growing_logs
from gradloom.streaming.runlogs import drain, stream_run_logs
from workbook.inputs import (
    LINES_SQL,
    LOG_FOLDER_PATTERN,
    SPARSE_SQL,
    SPLIT_SEED,
    hash_sql,
    in_id_order,
    split_vectors,
    table,
    vectors,
    with_zeros,
    written_logs,
)

R6 = lambda c: F.round(c, 6)


def _sparse(spark, sf_dir, below):
    return dense_to_sparse(with_zeros(vectors(spark, sf_dir), below))


def _entries(df, *keys):
    return df.select(*keys, F.inline(F.arrays_zip("indices", "values"))).select(
        *keys, F.col("indices").alias("i"), R6("values").alias("v")
    )


def _summary(df, *keys):
    total = F.aggregate("values", F.lit(0.0), lambda s, v: s + v)
    return df.select(*keys, F.size("indices").alias("entries"), R6(total).alias("total"))


def _written(spark, sf_dir, below, labelled=True):
    path = scratch_path(spark, "svmlight")
    write_svmlight(in_id_order(_sparse(spark, sf_dir, below)), path, labelled)
    return path


def a01_read_svmlight(spark, sf_dir):
    return _entries(read_svmlight(spark, _written(spark, sf_dir, 0.05)), "row_id", "label")


def a02_read_svmlight_unlabelled(spark, sf_dir):
    return _summary(read_svmlight_unlabelled(spark, _written(spark, sf_dir, 0.3, labelled=False)), "row_id")


def a03_row_ids(spark, sf_dir):
    return read_svmlight(spark, _written(spark, sf_dir, 0.05)).select("row_id", "label")


def a04_write_svmlight(spark, sf_dir):
    return _summary(read_svmlight(spark, _written(spark, sf_dir, 0.3)), "row_id", "label")


def a05_dense_source(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = from_dense(table(spark, sf_dir, "lineitem"), columns, "l_orderkey", "l_linenumber")
    return rows.select("row_id", "label", *[F.get("features", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def a06_triples_source(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    triples = rows.select("row_id", F.posexplode("features").alias("col", "value")).where(F.abs("value") >= 0.3)
    packed = from_triples(triples, rows.select("row_id"))
    weighted = F.aggregate(F.zip_with("indices", "values", lambda i, v: (i + 1) * v), F.lit(0.0), lambda s, v: s + v)
    return packed.select(
        "row_id",
        F.size("indices").alias("entries"),
        F.get("indices", F.lit(0)).alias("first_col"),
        R6(weighted).alias("weighted"),
    )


def a07_csv_features(spark, sf_dir):
    path = scratch_path(spark, "csv")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    part.write.csv(path, sep=";", header=True)
    schema = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return read_csv_features(
        spark, path, schema, "p_size", separator=";", ignore=["p_name"], id="p_partkey", label_offset=-1
    )


def a15_csv_in_file_order(spark, sf_dir):
    """Rows of several files without an id, numbered by file and place; the last fraction is held out."""
    path = scratch_path(spark, "csv")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    part.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").write.csv(path, header=True)
    rows = read_csv_features(spark, path, "p_partkey bigint, p_size int, p_retailprice double", "p_size")
    return csv_test_split(rows, 0.25).select("row_id", "p_partkey", "label", "split")


def a08_materialized_features(spark, sf_dir):
    stored = materialize_features(_sparse(spark, sf_dir, 0.3), scratch_path(spark, "features"))
    return _summary(stored, "row_id", "label")


def a09_feature_vocabulary(spark, sf_dir):
    rows = split_vectors(spark, sf_dir)
    sparse = dense_to_sparse(with_zeros(rows, 0.3)).withColumn(
        "indices", F.transform("indices", lambda i: i * 7 + 3)
    )
    vocabulary = feature_vocabulary(sparse.where(F.col("split") == "train"))
    return _entries(apply_vocabulary(sparse.where(F.col("split") == "test"), vocabulary), "row_id")


def a10_dataset_bundle(spark, sf_dir):
    rows = split_vectors(spark, sf_dir)
    train, test = (rows.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    return dataset_bundle(train, [test, train]).select("split", "row_id", "label")


def a11_read_run_logs(spark, sf_dir):
    lines = read_run_logs(spark, written_logs(spark, sf_dir), LOG_FOLDER_PATTERN)
    iteration = F.regexp_extract("value", r"'iteration': (\d+)", 1).cast("double")
    return lines.select("log", F.col("line_no").alias("place"), iteration.alias("iteration"))


def a12_stream_run_logs(spark, sf_dir):
    stream = stream_run_logs(spark, written_logs(spark, sf_dir), LOG_FOLDER_PATTERN)
    sink = scratch_path(spark, "streamed")
    drain(stream, sink, scratch_path(spark, "progress"))
    lines = spark.read.schema("log string, file_path string, line_no int, value string").parquet(sink)
    return lines.groupBy("log").agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars"))


def a13_call_history(spark, sf_dir):
    path = scratch_path(spark, "calls")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    events.select(F.to_json(F.struct(*events.columns)).alias("value")).write.text(path)
    return read_call_history(spark, path, "event_id bigint, user_id bigint, event_type string, value double")


def a14_follow_growing_logs(spark, sf_dir):
    """The same lines through the source that reads files by byte ranges as they grow."""
    stream = stream_growing_logs(spark, written_logs(spark, sf_dir))
    sink = scratch_path(spark, "streamed")
    drain(stream, sink, scratch_path(spark, "progress"))
    lines = spark.read.schema("log string, file_path string, line_no int, value string").parquet(sink)
    log = F.regexp_extract("file_path", LOG_FOLDER_PATTERN, 1)
    return lines.groupBy(log.alias("log")).agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars"))


QUERIES = [
    a01_read_svmlight, a02_read_svmlight_unlabelled, a03_row_ids, a04_write_svmlight, a05_dense_source,
    a06_triples_source, a07_csv_features, a08_materialized_features, a09_feature_vocabulary, a10_dataset_bundle,
    a11_read_run_logs, a12_stream_run_logs, a13_call_history, a14_follow_growing_logs,
    a15_csv_in_file_order,
]

_SUMMARY = "count(*) FILTER (abs(v) >= 0.3)::INT AS entries, round(coalesce(sum(v) FILTER (abs(v) >= 0.3), 0), 6) AS total"
_PLACE = "(dense_rank() OVER (ORDER BY row_id) - 1)"

_STREAMED = f"""
WITH {LINES_SQL}, t AS (
  SELECT log, '{{''iteration'': ' || (iteration::BIGINT) || ', ''' || metric || ''': ' ||
         CASE WHEN event_type = 'error' THEN '' ELSE value::VARCHAR || '}}' END AS text FROM lines)
SELECT log, count(*) AS lines, sum(length(text))::BIGINT AS chars FROM t GROUP BY log"""

SQL = {
    "a01_read_svmlight": f"""
WITH {SPARSE_SQL}, n AS (SELECT *, {_PLACE} AS place FROM e)
SELECT place AS row_id, label, i::INT AS i, round(v, 6) AS v FROM n WHERE abs(v) >= 0.05""",
    "a02_read_svmlight_unlabelled": f"""
WITH {SPARSE_SQL}, n AS (SELECT *, {_PLACE} AS place FROM e)
SELECT place AS row_id, {_SUMMARY} FROM n GROUP BY place""",
    "a03_row_ids": "SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row_id, label FROM embeddings",
    "a04_write_svmlight": f"""
WITH {SPARSE_SQL}, n AS (SELECT *, {_PLACE} AS place FROM e)
SELECT place AS row_id, label, {_SUMMARY} FROM n GROUP BY place, label""",
    "a05_dense_source": """
SELECT l_orderkey AS row_id, l_linenumber AS label, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""",
    "a06_triples_source": f"""
WITH {SPARSE_SQL}
SELECT row_id, count(*) FILTER (abs(v) >= 0.3)::INT AS entries, (min(i) FILTER (abs(v) >= 0.3))::INT AS first_col,
       round(coalesce(sum((i + 1) * v) FILTER (abs(v) >= 0.3), 0), 6) AS weighted
FROM e GROUP BY row_id""",
    "a07_csv_features": """
SELECT p_partkey AS row_id, p_brand, p_type, (p_size - 1)::INT AS label, p_retailprice FROM part""",
    "a15_csv_in_file_order": """
WITH n AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS place, count(*) OVER () AS parts FROM part)
SELECT place AS row_id, p_partkey, p_size::INT AS label, CASE WHEN place >= floor(parts * 0.75) THEN 'test' ELSE 'train' END AS split FROM n""",
    "a08_materialized_features": f"WITH {SPARSE_SQL} SELECT row_id, label, {_SUMMARY} FROM e GROUP BY row_id, label",
    "a09_feature_vocabulary": f"""
WITH {SPARSE_SQL}, s AS (SELECT *, {hash_sql(SPLIT_SEED, 'row_id')} < 200 AS test FROM e WHERE abs(v) >= 0.3),
vocabulary AS (SELECT i, row_number() OVER (ORDER BY i) - 1 AS place FROM (SELECT DISTINCT i FROM s WHERE NOT test))
SELECT row_id, place::INT AS i, round(v, 6) AS v FROM s JOIN vocabulary USING (i) WHERE test""",
    "a10_dataset_bundle": f"""
WITH s AS (SELECT vec_id AS row_id, label, {hash_sql(SPLIT_SEED, 'vec_id')} < 200 AS test FROM embeddings)
SELECT 'train' AS split, row_id, label FROM s WHERE NOT test
UNION ALL SELECT 'val_1', row_id, label FROM s WHERE test
UNION ALL SELECT 'val_2', row_id, label FROM s WHERE NOT test""",
    "a11_read_run_logs": f"""
WITH {LINES_SQL}
SELECT log, row_number() OVER (PARTITION BY log ORDER BY line_no) - 1 AS place, iteration FROM lines""",
    "a12_stream_run_logs": _STREAMED,
    "a14_follow_growing_logs": _STREAMED,
    "a13_call_history": "SELECT event_id, user_id, event_type, value FROM events",
}
