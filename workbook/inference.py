"""Queries over scoring and score layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradloom.functions.vectors import dense_to_sparse, predicted_class
from gradloom.operators.scores import best_n_scores, long_scores, scatter_scores
from gradloom.plans.training import SoftmaxRegression
from gradloom.session import scratch_path
from gradloom.sources.svmlight import read_svmlight, write_svmlight
from workbook.inputs import NCLASSES, in_id_order, one_step_model, scored_sql, split_vectors, vectors

R6 = lambda c: F.round(c, 6)


def _long(spark, sf_dir):
    return long_scores(one_step_model(spark, sf_dir).predict_proba(vectors(spark, sf_dir)))


def d01_predict_proba(spark, sf_dir):
    return _long(spark, sf_dir).select("row_id", "cat", R6("prob").alias("prob"))


def d02_scatter_scores(spark, sf_dir):
    """Dense rows from the classes above one tenth only; the rest is absent and becomes 0."""
    likely = _long(spark, sf_dir).where(F.col("prob") > 0.1)
    return scatter_scores(likely, NCLASSES, vectors(spark, sf_dir).select("row_id")).select(
        "row_id", *[R6(F.get("scores", F.lit(k))).alias(f"p{k}") for k in range(NCLASSES)]
    )


def d03_best_n(spark, sf_dir):
    scored = one_step_model(spark, sf_dir).predict_proba(vectors(spark, sf_dir))
    return best_n_scores(scored, 3).select("row_id", "cat", "place")


def d04_predict_class(spark, sf_dir):
    """Classes of score rows in which all scores at or under 0.12 are blanked, so that all-zero rows occur."""
    scored = one_step_model(spark, sf_dir).predict_proba(vectors(spark, sf_dir))
    blanked = F.transform("scores", lambda p: F.when(p > 0.12, p).otherwise(0.0))
    return scored.select("row_id", predicted_class(blanked).alias("pred"))


def d05_predict_stored(spark, sf_dir):
    """Predictions for a sparse text file and for a stored feature table hold the same classes."""
    model = one_step_model(spark, sf_dir)
    rows = vectors(spark, sf_dir)
    text, stored = scratch_path(spark, "svmlight"), scratch_path(spark, "features")
    write_svmlight(in_id_order(dense_to_sparse(rows)), text)
    rows.write.parquet(stored)
    from_text = model.predict(read_svmlight(spark, text)).select("row_id", "pred", F.lit("text").alias("source"))
    from_table = model.predict(spark.read.parquet(stored)).select("row_id", "pred", F.lit("table").alias("source"))
    return from_text.unionByName(from_table)


def d06_predict_reloaded(spark, sf_dir):
    """Predictions of a model read back from its folder, and whether each equals the one made before."""
    model = one_step_model(spark, sf_dir)
    again = SoftmaxRegression(NCLASSES, repository=model.repository, finetuning=True)
    rows = split_vectors(spark, sf_dir)
    before = model.predict(rows).select("row_id", "pred", "scores")
    after = again.predict(rows).select("row_id", "pred", "scores")
    lost = before.exceptAll(after).unionByName(after.exceptAll(before))
    return after.select("row_id", "pred").unionByName(lost.select("row_id", "pred"))


QUERIES = [
    d01_predict_proba, d02_scatter_scores, d03_best_n, d04_predict_class, d05_predict_stored, d06_predict_reloaded,
]

_ABSENT = ", ".join(f"round(coalesce(max(p) FILTER (k = {k} AND p > 0.1), 0), 6) AS p{k}" for k in range(NCLASSES))

SQL = {
    "d01_predict_proba": f"{scored_sql()} SELECT row_id, k::INT AS cat, round(p, 6) AS prob FROM prob",
    "d02_scatter_scores": f"{scored_sql()} SELECT row_id, {_ABSENT} FROM prob GROUP BY row_id",
    "d03_best_n": f"""{scored_sql()}
SELECT row_id, k::INT AS cat, row_number() OVER (PARTITION BY row_id ORDER BY p DESC, k)::INT AS place FROM prob
QUALIFY place <= 3""",
    "d04_predict_class": f"""{scored_sql()},
b AS (SELECT row_id, k, CASE WHEN p > 0.12 THEN p ELSE 0 END AS p FROM prob)
SELECT row_id, k::INT AS pred FROM b QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY p DESC, k) = 1""",
    "d05_predict_stored": f"""{scored_sql()}, n AS (SELECT dense_rank() OVER (ORDER BY row_id) - 1 AS place, * FROM pred)
SELECT place AS row_id, pred::INT AS pred, 'text' AS source FROM n
UNION ALL SELECT row_id, pred::INT, 'table' FROM n""",
    "d06_predict_reloaded": f"{scored_sql()} SELECT row_id, pred::INT AS pred FROM pred",
}
