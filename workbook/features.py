"""Queries over projections and feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradloom.functions.vectors import (
    class_weight,
    dense_to_sparse,
    format_value,
    format_value_16g,
    sparse_to_dense,
    sparse_to_text,
)
from gradloom.operators.ordering import dense_positions, shuffle_rows
from gradloom.operators.prepare import (
    StandardScaler,
    assign_minibatch,
    bounds_of,
    categorical_apply,
    categorical_entries,
    categorical_fit,
    csv_test_split,
    minmax_apply,
    minmax_fit,
)
from gradloom.operators.vocabulary import text_features
from gradloom.session import reliable_checkpoint
from gradloom.sources.tables import drop_ignored, keep_id, offset_label
from workbook.inputs import SPARSE_SQL, SPLIT_SEED, dealt_table, hash_sql, split_vectors, table, vectors, with_zeros

R6 = lambda c: F.round(c, 6)
WEIGHTS = [0.5 * (k + 1) for k in range(10)]
SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


def b01_dense_to_sparse(spark, sf_dir):
    sparse = dense_to_sparse(with_zeros(vectors(spark, sf_dir), 0.05))
    return sparse.select("row_id", F.inline(F.arrays_zip("indices", "values"))).select(
        "row_id", F.col("indices").alias("i"), R6("values").alias("v")
    )


def b02_sparse_to_text(spark, sf_dir):
    """Values rounded to three places, among them explicit zeros, as text."""
    rows = vectors(spark, sf_dir).select(
        "row_id",
        F.transform("features", lambda v, i: i).alias("indices"),
        F.transform("features", lambda v: F.round(v, 3)).alias("values"),
    )
    return rows.select("row_id", sparse_to_text().alias("text"))


def b03_sparse_to_dense(spark, sf_dir):
    dense = sparse_to_dense(dense_to_sparse(with_zeros(vectors(spark, sf_dir), 0.3)), 64)
    return dense.select("row_id", F.posexplode("features").alias("i", "v")).withColumn("v", R6("v"))


def b04_format_value(spark, sf_dir):
    values = vectors(spark, sf_dir).select("row_id", F.posexplode("features").alias("i", "v"))
    return values.select(
        "row_id", "i", format_value_16g(F.col("v")).alias("text"), (format_value(F.col("v")).cast("double") == F.col("v")).alias("same")
    )


def b05_standard_scale(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    scaled = StandardScaler.fit(rows).apply(rows)
    return scaled.select("row_id", F.posexplode("features").alias("i", "v")).withColumn("v", R6("v"))


def b06_train_test_split(spark, sf_dir):
    return split_vectors(spark, sf_dir).select("row_id", "split")


def b07_minmax_fit(spark, sf_dir):
    fitted = minmax_fit(table(spark, sf_dir, "lineitem"), SCALED)
    return fitted.select("column", *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("low", "high")])  # -0.0 is 0.0


def b08_minmax_apply(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *SCALED)
    scaled = minmax_apply(rows, bounds_of(minmax_fit(rows, SCALED)))
    return scaled.select("l_orderkey", "l_linenumber", *[R6(c).alias(c) for c in SCALED])


def b09_offset_label(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("label"))
    return offset_label(rows, -1)


def b10_drop_ignored(spark, sf_dir):
    return drop_ignored(table(spark, sf_dir, "orders"), ["o_orderdate", "o_custkey"])


def b11_keep_id(spark, sf_dir):
    return keep_id(table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_acctbal"), "c_custkey")


def b12_categorical_fit(spark, sf_dir):
    return categorical_fit(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


def b13_categorical_apply(spark, sf_dir):
    """The mapping comes from finished orders, so a status it lacks turns into zeros."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderpriority", "o_orderstatus"]
    mapping = categorical_fit(orders.where(F.col("o_orderstatus") != "P"), columns)
    coded = categorical_apply(orders.select("o_orderkey", *columns), mapping, columns)
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("int").cast("string")), "").alias(c)
    return coded.select("o_orderkey", *[text(c) for c in columns])


def b19_categorical_entries(spark, sf_dir):
    """Categories as sparse entries: ids of the second column follow those of the first."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderpriority", "o_orderstatus"]
    mapping = categorical_fit(orders.where(F.col("o_orderstatus") != "P"), columns)
    coded = categorical_entries(orders.select("o_orderkey", *columns), mapping, columns)
    return coded.select("o_orderkey", F.array_join(F.col("indices").cast("array<string>"), ",").alias("ids"), F.size("values").alias("entries"))


def b14_shuffle_rows(spark, sf_dir):
    """Rows in seeded order; the order is kept as the place inside of the ordered partitions."""
    ordered = shuffle_rows(table(spark, sf_dir, "orders").select("o_orderkey"), 5, "o_orderkey")
    placed = reliable_checkpoint(ordered).withColumn("seq", F.monotonically_increasing_id())
    return dense_positions(placed, ["seq"]).select("o_orderkey", "position")


def b15_csv_test_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    plain = csv_test_split(orders, 0.3, row_id="o_orderkey").withColumn("shuffled", F.lit(False))
    shuffled = csv_test_split(orders, 0.3, True, 5, "o_orderkey").withColumn("shuffled", F.lit(True))
    return plain.unionByName(shuffled)


def b16_class_weight(spark, sf_dir):
    return vectors(spark, sf_dir).select("row_id", class_weight(F.col("label"), WEIGHTS, 10).alias("weight"))


def b17_assign_minibatch(spark, sf_dir):
    return assign_minibatch(table(spark, sf_dir, "orders").select("o_orderkey"), 128, 2, 3, "o_orderkey")


def b18_text_features(spark, sf_dir):
    rows, _ = text_features(dealt_table(spark, sf_dir, "documents", "doc_id", "text"), "text", "doc_id")
    return rows.select("row_id", F.inline(F.arrays_zip("indices", "values"))).withColumnsRenamed(
        {"indices": "word", "values": "n"}
    )


QUERIES = [
    b01_dense_to_sparse, b02_sparse_to_text, b03_sparse_to_dense, b04_format_value, b05_standard_scale,
    b06_train_test_split, b07_minmax_fit, b08_minmax_apply, b09_offset_label, b10_drop_ignored, b11_keep_id,
    b12_categorical_fit, b13_categorical_apply, b14_shuffle_rows, b15_csv_test_split, b16_class_weight,
    b17_assign_minibatch, b18_text_features, b19_categorical_entries,
]

_ONE_HOT = (
    "CASE WHEN {p}.place IS NULL THEN repeat('0', {n}::INT) ELSE "
    "repeat('0', {p}.place::INT) || '1' || repeat('0', ({n} - {p}.place - 1)::INT) END"
)

SQL = {
    "b01_dense_to_sparse": f"WITH {SPARSE_SQL} SELECT row_id, i::INT AS i, round(v, 6) AS v FROM e WHERE abs(v) >= 0.05",
    "b02_sparse_to_text": f"""
WITH {SPARSE_SQL}
SELECT row_id, string_agg(i || ':' || regexp_replace((round(v, 3) + 0.0)::DOUBLE::VARCHAR, '\\.0$', ''), ' ' ORDER BY i) AS text
FROM e GROUP BY row_id""",
    "b03_sparse_to_dense": f"""
WITH {SPARSE_SQL} SELECT row_id, i::INT AS i, CASE WHEN abs(v) < 0.3 THEN 0 ELSE round(v, 6) END AS v FROM e""",
    "b04_format_value": f"WITH {SPARSE_SQL} SELECT row_id, i::INT AS i, printf('%.16g', v) AS text, true AS same FROM e",
    "b05_standard_scale": f"""
WITH {SPARSE_SQL}, s AS (SELECT i, avg(v) AS mean, stddev_pop(v) AS dev FROM e GROUP BY i)
SELECT row_id, i::INT AS i, round((v - mean) / CASE WHEN dev = 0 THEN 1 ELSE dev END, 6) + 0.0 AS v FROM e JOIN s USING (i)""",
    "b06_train_test_split": f"""
SELECT vec_id AS row_id, CASE WHEN {hash_sql(SPLIT_SEED, 'vec_id')} < 200 THEN 'test' ELSE 'train' END AS split
FROM embeddings""",
    "b07_minmax_fit": " UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", min({c}) + 0.0::DOUBLE AS low, max({c}) + 0.0::DOUBLE AS high FROM lineitem' for c in SCALED
    ),
    "b08_minmax_apply": "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in SCALED)
    + " FROM lineitem",
    "b09_offset_label": "SELECT p_partkey, (p_size - 1)::INT AS label FROM part",
    "b10_drop_ignored": "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "b11_keep_id": "SELECT c_custkey AS row_id, c_name, c_acctbal FROM customer",
    "b12_categorical_fit": """
SELECT "column", value, (row_number() OVER (PARTITION BY "column" ORDER BY value) - 1)::INT AS position FROM (
  SELECT DISTINCT 'o_orderpriority' AS "column", o_orderpriority AS value FROM orders
  UNION ALL SELECT DISTINCT 'o_orderstatus', o_orderstatus FROM orders)""",
    "b13_categorical_apply": f"""
WITH known AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
a AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place, count(*) OVER () AS n
      FROM (SELECT DISTINCT o_orderpriority AS v FROM known)),
b AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place, count(*) OVER () AS n
      FROM (SELECT DISTINCT o_orderstatus AS v FROM known))
SELECT o_orderkey, {_ONE_HOT.format(p='a', n='(SELECT max(n) FROM a)')} AS o_orderpriority,
       {_ONE_HOT.format(p='b', n='(SELECT max(n) FROM b)')} AS o_orderstatus
FROM orders LEFT JOIN a ON a.v = o_orderpriority LEFT JOIN b ON b.v = o_orderstatus""",
    "b19_categorical_entries": """
WITH known AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
a AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place FROM (SELECT DISTINCT o_orderpriority AS v FROM known)),
b AS (SELECT v, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY v) - 1 AS place FROM (SELECT DISTINCT o_orderstatus AS v FROM known))
SELECT o_orderkey, concat_ws(',', a.place, b.place) AS ids, ((a.place IS NOT NULL)::INT + (b.place IS NOT NULL)::INT)::INT AS entries
FROM orders LEFT JOIN a ON a.v = o_orderpriority LEFT JOIN b ON b.v = o_orderstatus""",
    "b14_shuffle_rows": """
SELECT o_orderkey, row_number() OVER (ORDER BY md5('5:' || o_orderkey), o_orderkey) - 1 AS position FROM orders""",
    "b15_csv_test_split": """
WITH n AS (SELECT floor(count(*) * 0.7) AS cut FROM orders)
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1 >= cut THEN 'test' ELSE 'train' END AS split,
       false AS shuffled FROM orders, n
UNION ALL
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('5:' || o_orderkey), o_orderkey) - 1 >= cut
                        THEN 'test' ELSE 'train' END, true FROM orders, n""",
    "b16_class_weight": "SELECT vec_id AS row_id, 0.5::DOUBLE * (label + 1) AS weight FROM embeddings",
    "b17_assign_minibatch": """
SELECT o_orderkey, (row_number() OVER (ORDER BY md5('3:' || o_orderkey), o_orderkey) - 1) // 256 AS batch_id FROM orders""",
    "b18_text_features": """
WITH w AS (SELECT doc_id AS row_id, unnest(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+')) AS t FROM documents),
c AS (SELECT row_id, t, count(*)::DOUBLE AS n FROM w WHERE t <> '' GROUP BY row_id, t),
v AS (SELECT t, (row_number() OVER (ORDER BY t) - 1)::INT AS word FROM (SELECT DISTINCT t FROM c))
SELECT row_id, word, n FROM c JOIN v USING (t)""",
}
