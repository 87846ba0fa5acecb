"""Queries over evaluation metrics, on the one-step model."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradloom.operators import metrics
from gradloom.operators.prepare import train_test_split
from gradloom.operators.runlog import drop_bad_lines, monotonic_filter, parse_lines, smoothed_loss, unpivot_metrics
from gradloom.plans.solver import SolverConfig
from gradloom.plans.training import SoftmaxRegression
from workbook.inputs import (
    LINES_SQL,
    NCLASSES,
    X_SQL,
    hash_sql,
    log_lines,
    one_step_model,
    one_step_scores,
    predictions,
    probabilities,
    scored_sql,
    softmax_chain,
    training_rows,
    vectors,
)

R6 = lambda c: F.round(c, 6) + F.lit(0.0)


def _rounded(long):
    return long.select("split", "metric", R6("value").alias("value"))


def _confusion(spark, sf_dir):
    return metrics.confusion_matrix(one_step_scores(spark, sf_dir))


def e01_confusion_matrix(spark, sf_dir):
    return _confusion(spark, sf_dir).select("split", "label", "pred", "n")


def e02_accuracy(spark, sf_dir):
    confusion = _confusion(spark, sf_dir)
    return _rounded(metrics.accuracy(confusion, "acc").unionByName(metrics.accuracy(confusion, "accp")))


def _macro(spark, sf_dir, metric):
    return _rounded(metrics.macro_metrics(_confusion(spark, sf_dir), NCLASSES).where(F.col("metric") == metric))


def e04_precision(spark, sf_dir):
    return _macro(spark, sf_dir, "precision")


def e05_recall(spark, sf_dir):
    return _macro(spark, sf_dir, "recall")


def e06_f1(spark, sf_dir):
    return _macro(spark, sf_dir, "f1")


def e07_mcc(spark, sf_dir):
    return _rounded(metrics.matthews(_confusion(spark, sf_dir)))


def e08_mcll(spark, sf_dir):
    return _rounded(metrics.log_loss(_confusion(spark, sf_dir)))


def e09_auc(spark, sf_dir):
    """One-versus-rest over ten classes, and the two-class area of class 0 against all others."""
    scored = one_step_scores(spark, sf_dir)
    many = metrics.area_under_curve(scored, NCLASSES)
    pair = scored.select(
        "split",
        (F.col("label") == 0).cast("int").alias("label"),
        F.array(1.0 - F.get("scores", F.lit(0)), F.get("scores", F.lit(0))).alias("scores"),
    )
    two = metrics.area_under_curve(pair, 2).withColumn("metric", F.lit("auc of class 0"))
    return _rounded(many.unionByName(two))


def e10_train_loss(spark, sf_dir):
    """Class-weighted losses of two steps."""
    weights = [0.5 + 0.25 * k for k in range(NCLASSES)]
    log = SoftmaxRegression(NCLASSES).fit(
        training_rows(spark, sf_dir), solver=SolverConfig(iterations=2, base_lr=1.0), batch_size=None, class_weights=weights
    )
    return log.where(F.col("metric") == "train_loss").select("iteration", R6("value").alias("value"))


def e11_smoothed_loss(spark, sf_dir):
    kept = monotonic_filter(drop_bad_lines(parse_lines(log_lines(spark, sf_dir))))
    smoothed = smoothed_loss(unpivot_metrics(kept), 3)
    return smoothed.select("log", "iteration", "value", R6("smoothed_loss").alias("smoothed_loss"))


def e12_classification_report(spark, sf_dir):
    report = metrics.classification_report(_confusion(spark, sf_dir), NCLASSES)
    return report.select("split", "row", *[R6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


def e13_evaluate_sets(spark, sf_dir):
    """All metrics of two validation sets cut by another hash."""
    rows = train_test_split(vectors(spark, sf_dir), 0.4, 11)
    scored = metrics.with_prediction(one_step_model(spark, sf_dir).predict_proba(rows))
    wanted = [*metrics.CONFUSION_METRICS, *metrics.SCORE_METRICS]
    return _rounded(metrics.evaluate_sets(scored, wanted, NCLASSES))


QUERIES = [
    e01_confusion_matrix, e02_accuracy, e04_precision, e05_recall, e06_f1, e07_mcc, e08_mcll, e09_auc, e10_train_loss,
    e11_smoothed_loss, e12_classification_report, e13_evaluate_sets,
]

_PER_CLASS = """
cm AS (SELECT split, label, pred, count(*) AS n FROM pred GROUP BY ALL),
pc AS (
  SELECT split, c AS class,
         coalesce(sum(n) FILTER (label = c AND pred = c), 0)::DOUBLE AS tp,
         coalesce(sum(n) FILTER (pred = c), 0)::DOUBLE AS predicted, coalesce(sum(n) FILTER (label = c), 0)::DOUBLE AS support
  FROM cm, range(10) t(c) GROUP BY split, c),
prf AS (
  SELECT split, class, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
         CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1 FROM pc)"""

_ACC = "SELECT split, '{0}' AS metric, round(avg((label = pred)::INT), 6) AS value FROM pred GROUP BY split"
_MACRO = "SELECT split, '{0}' AS metric, round(avg({0}), 6) AS value FROM prf GROUP BY split"
_MCC = """
SELECT split, 'mcc' AS metric, round(CASE WHEN (s * s - pp) * (s * s - tt) > 0
         THEN (c * s - tp) / sqrt((s * s - pp) * (s * s - tt)) ELSE 0 END, 6) + 0.0 AS value
FROM (SELECT split, sum(tp) AS c, sum(support) AS s, sum(predicted * support) AS tp, sum(predicted * predicted) AS pp,
             sum(support * support) AS tt FROM pc GROUP BY split)"""
_MCLL = """
SELECT split, 'mcll' AS metric, round(avg(-ln(least(greatest(p, 1e-15), 1))), 6) + 0.0 AS value
FROM prob WHERE k = label GROUP BY split"""
_AUC = """
SELECT split, 'auc' AS metric, round(avg(a), 6) AS value FROM (
  SELECT p.split, p.k, avg((p.p > n.p)::INT + (p.p = n.p)::INT / 2.0::DOUBLE) AS a
  FROM prob p JOIN prob n ON p.split = n.split AND p.k = n.k AND p.label = p.k AND n.label <> n.k
  GROUP BY p.split, p.k) GROUP BY split"""
_AUC_0 = """
SELECT p.split, 'auc of class 0' AS metric, round(avg((p.p > n.p)::INT + (p.p = n.p)::INT / 2.0::DOUBLE), 6) AS value
FROM prob p JOIN prob n ON p.split = n.split AND p.k = 0 AND n.k = 0 AND p.label = 0 AND n.label <> 0 GROUP BY p.split"""
_AVERAGE = """
SELECT split, '{0}' AS row, {1}, sum(support)::BIGINT AS support FROM prf GROUP BY split"""
_THREE = ("precision", "recall", "f1")

SQL = {
    "e01_confusion_matrix": f"""{scored_sql()}
SELECT split, label, pred::INT AS pred, count(*) AS n FROM pred GROUP BY ALL""",
    "e02_accuracy": f"{scored_sql()} {_ACC.format('acc')} UNION ALL {_ACC.format('accp')}",
    "e04_precision": f"{scored_sql()}, {_PER_CLASS} {_MACRO.format('precision')}",
    "e05_recall": f"{scored_sql()}, {_PER_CLASS} {_MACRO.format('recall')}",
    "e06_f1": f"{scored_sql()}, {_PER_CLASS} {_MACRO.format('f1')}",
    "e07_mcc": f"{scored_sql()}, {_PER_CLASS} {_MCC}",
    "e08_mcll": f"{scored_sql()} {_MCLL}",
    "e09_auc": f"{scored_sql()} {_AUC} UNION ALL {_AUC_0}",
    "e10_train_loss": f"""
WITH {X_SQL}, {softmax_chain(2, class_weights=[0.5 + 0.25 * k for k in range(NCLASSES)])}
"""
    + " UNION ALL ".join(
        f"SELECT {t + 1}::DOUBLE AS iteration, round(sum(-ln(p) * (0.5 + 0.25 * label)) / sum(0.5 + 0.25 * label), 6) AS value "
        f"FROM p{t} WHERE k = label"
        for t in (0, 1)
    ),
    "e11_smoothed_loss": f"""
WITH {LINES_SQL}
SELECT log, iteration, value, round(avg(value) OVER (
  PARTITION BY log ORDER BY iteration ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS smoothed_loss
FROM kept WHERE metric = 'train_loss'""",
    "e12_classification_report": f"{scored_sql()}, {_PER_CLASS} "
    + "SELECT split, class::VARCHAR AS row, "
    + ", ".join(f"round({m}, 6) AS {m}" for m in _THREE)
    + ", support::BIGINT AS support FROM prf UNION ALL "
    + _AVERAGE.format("macro avg", ", ".join(f"round(avg({m}), 6) AS {m}" for m in _THREE))
    + " UNION ALL "
    + _AVERAGE.format("weighted avg", ", ".join(f"round(sum({m} * support) / sum(support), 6) AS {m}" for m in _THREE)),
    "e13_evaluate_sets": f"""
WITH {X_SQL}, {softmax_chain(1)},
xs AS (SELECT row_id, label, f, v, CASE WHEN {hash_sql(11, 'row_id')} < 400 THEN 'test' ELSE 'train' END AS split FROM x),
{probabilities('prob', 'w1', 'xs')}, {predictions('pred', 'prob')}, {_PER_CLASS}
"""
    + " UNION ALL ".join(
        [_ACC.format("acc"), _ACC.format("accp"), *[_MACRO.format(m) for m in _THREE], _MCC, _MCLL, _AUC]
    ),
}
