"""Classification metrics over ``label``/``pred``/``scores`` rows, per ``split``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradloom.functions.vectors import predicted_class
from gradloom.operators.ordering import prefix_sum

# Metrics that need no more than the confusion table, and those that need scores.
CONFUSION_METRICS = ("acc", "accp", "precision", "recall", "f1", "mcc")
SCORE_METRICS = ("mcll", "auc")


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """``split``, ``label``, ``pred``, ``n``: nclasses² rows per split, whatever the input size.

    With scores at hand it also sums ``nll``, -ln p(true class) with p clipped to [1e-15, 1], in the same pass.
    """
    sums = [F.count("*").alias("n")]
    if "scores" in scored.columns:
        clipped = F.least(F.greatest(F.get("scores", F.col("label")), F.lit(1e-15)), F.lit(1.0))
        sums.append(F.sum(-F.log(clipped)).alias("nll"))
    return scored.groupBy("split", "label", "pred").agg(*sums)


def per_class(confusion: DataFrame, nclasses: int) -> DataFrame:
    """Precision, recall, f1 and support of every class 0..nclasses-1; 0/0 counts as 0."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(zero)
    # A cell counts once for its label and once for its prediction; classes without cells come from the list of classes.
    by_label = confusion.select("split", F.col("label").alias("class"), hit.alias("tp"), zero.alias("predicted"), F.col("n").alias("support"))
    by_pred = confusion.select("split", F.col("pred").alias("class"), zero.alias("tp"), F.col("n").alias("predicted"), zero.alias("support"))
    every = confusion.select("split").distinct().select(
        "split", F.explode(F.sequence(F.lit(0), F.lit(nclasses - 1))).alias("class"), zero.alias("tp"), zero.alias("predicted"), zero.alias("support")
    )
    cells = by_label.unionByName(by_pred).unionByName(every).where(F.col("class").between(0, nclasses - 1))
    counts = cells.groupBy("split", "class").agg(*[F.sum(c).cast("double").alias(c) for c in ("tp", "predicted", "support")])
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    both = F.col("predicted") + F.col("support")
    f1 = F.when(both > 0, 2.0 * F.col("tp") / both).otherwise(0.0)
    return counts.select(
        "split", "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


def macro_metrics(confusion: DataFrame, nclasses: int) -> DataFrame:
    """``split``, ``metric``, ``value`` for precision, recall and f1, averaged over classes."""
    means = per_class(confusion, nclasses).groupBy("split").agg(
        *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")]
    )
    return _long(means, ("precision", "recall", "f1"))


def accuracy(confusion: DataFrame, name: str = "acc") -> DataFrame:
    correct = F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0))
    return _long(confusion.groupBy("split").agg((correct / F.sum("n")).alias(name)), (name,))


def matthews(confusion: DataFrame) -> DataFrame:
    """Multiclass correlation from the marginals of the confusion table; 0 when a marginal is constant."""
    t = confusion.groupBy("split", "label").agg(F.sum("n").cast("double").alias("t"))
    p = confusion.groupBy("split", F.col("pred").alias("label")).agg(F.sum("n").cast("double").alias("p"))
    marginals = (
        t.join(p, ["split", "label"], "full")
        .fillna(0.0, ["t", "p"])
        .groupBy("split")
        .agg(F.sum(F.col("t") * F.col("p")).alias("tp"), F.sum(F.col("t") ** 2).alias("tt"), F.sum(F.col("p") ** 2).alias("pp"))
    )
    totals = confusion.groupBy("split").agg(
        F.sum("n").cast("double").alias("s"),
        F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)).cast("double").alias("c"),
    )
    spread = F.sqrt((F.col("s") ** 2 - F.col("pp")) * (F.col("s") ** 2 - F.col("tt")))
    value = F.when(spread > 0, (F.col("c") * F.col("s") - F.col("tp")) / spread).otherwise(0.0)
    return _long(totals.join(marginals, "split").select("split", value.alias("mcc")), ("mcc",))


def log_loss(confusion: DataFrame) -> DataFrame:
    """Mean of -ln p(true class)."""
    return _long(confusion.groupBy("split").agg((F.sum("nll") / F.sum("n")).alias("mcll")), ("mcll",))


def area_under_curve(scored: DataFrame, nclasses: int) -> DataFrame:
    """Mann-Whitney area, ties half. Two classes use the score of class 1, more average one-versus-rest.

    Rows collapse to counts per distinct score first; the running count of negatives comes from range-wise
    prefix sums. A class without both kinds of rows is left out of the average.
    """
    if nclasses == 2:
        pairs = scored.select("split", F.lit(1).alias("class"), F.get("scores", F.lit(1)).alias("score"),
                              (F.col("label") == 1).alias("positive"))
    else:
        pairs = scored.select("split", "label", F.posexplode("scores").alias("class", "score")).select(
            "split", "class", "score", (F.col("label") == F.col("class")).alias("positive")
        )
    counts = pairs.groupBy("split", "class", "score").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("n")
    )
    ranked = prefix_sum(counts, ["split", "class", "score"], "n", "below")
    p, n, below = (F.col(c).cast("double") for c in ("p", "n", "below"))
    areas = ranked.groupBy("split", "class").agg(
        F.sum(p * (below + n / 2.0)).alias("raw"),
        F.sum(p).alias("P"),
        F.sum(n).alias("N"),
        F.min(below).alias("before"),
    )
    area = (F.col("raw") - F.col("P") * F.col("before")) / (F.col("P") * F.col("N"))
    usable = areas.where((F.col("P") > 0) & (F.col("N") > 0)).withColumn("auc", area)
    return _long(usable.groupBy("split").agg(F.avg("auc").alias("auc")), ("auc",))


def classification_report(confusion: DataFrame, nclasses: int) -> DataFrame:
    """Per-class rows followed by the macro and the support-weighted averages."""
    classes = per_class(confusion, nclasses)
    named = classes.select("split", F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    macro = classes.groupBy("split").agg(
        F.lit("macro avg").alias("row"),
        *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    )
    weighted = classes.groupBy("split").agg(
        F.lit("weighted avg").alias("row"),
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    )
    return named.unionByName(macro).unionByName(weighted).withColumn("support", F.col("support").cast("bigint"))


def evaluate_sets(
    scored: DataFrame, metrics: Sequence[str], nclasses: int, confusion: DataFrame | None = None
) -> DataFrame:
    """``split``, ``metric``, ``value``: the requested metrics of every tagged set."""
    unknown = set(metrics) - set(CONFUSION_METRICS) - set(SCORE_METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}")
    confusion = confusion_matrix(scored) if confusion is None else confusion
    parts = [accuracy(confusion, m) for m in metrics if m in ("acc", "accp")]
    macro = [m for m in metrics if m in ("precision", "recall", "f1")]
    if macro:
        parts.append(macro_metrics(confusion, nclasses).where(F.col("metric").isin(macro)))
    if "mcc" in metrics:
        parts.append(matthews(confusion))
    if "mcll" in metrics:
        parts.append(log_loss(confusion))
    if "auc" in metrics:
        parts.append(area_under_curve(scored, nclasses))
    return reduce(DataFrame.unionByName, parts)


def with_prediction(scored: DataFrame) -> DataFrame:
    return scored.withColumn("pred", predicted_class("scores"))


def _long(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.unpivot(["split"], list(names), "metric", "value")
