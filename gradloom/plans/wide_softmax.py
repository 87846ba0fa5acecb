"""Softmax regression whose weights are a table: for more features than a broadcast may carry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradloom.functions.vectors import class_weight, predicted_class
from gradloom.plans.solver import SolverConfig
from gradloom.session import scratch_path


class WideSoftmaxRegression:
    """Full-batch SGD with momentum on ``row_id``/``label``/``indices``/``values`` rows.

    Entries meet their weights in a join on the feature, residuals meet the entries in a join on the row, and
    gradients are partial sums per feature. Features that most rows carry are split by the adaptive skew join.
    Every step writes the weights to ``repository``, which cuts the lineage and serves as snapshot.
    """

    def __init__(self, nclasses: int, repository: str = ""):
        self.nclasses, self.repository = nclasses, repository
        self.bias = [0.0] * nclasses
        self.weights: DataFrame | None = None

    def fit(
        self, train: DataFrame, solver: SolverConfig | None = None, class_weights: Sequence[float] | None = None
    ) -> WideSoftmaxRegression:
        solver = solver or SolverConfig()
        if solver.solver_type != "SGD":
            raise ValueError("a table of weights is trained by SGD")
        spark, k = train.sparkSession, self.nclasses
        self.repository = self.repository or scratch_path(spark, "wide")
        rows = train.withColumn("_weight", class_weight(F.col("label"), class_weights, k))
        total = rows.agg(F.sum("_weight")).head()[0]
        mu, decay = solver.momentum or 0.0, solver.weight_decay or 0.0
        zero = F.array_repeat(F.lit(0.0), k)
        features = train.select(F.explode("indices").alias("feature")).distinct()
        self._keep(features.select("feature", zero.alias("w"), zero.alias("m")), 0)
        self.bias, speed = [0.0] * k, [0.0] * k
        for step in range(solver.iterations):
            rate = solver.rate(step)
            scored = self._scores(rows.select("row_id", "label", "_weight", "indices", "values"))
            hit = lambda p, i: (p - (i == F.col("label")).cast("double")) * F.col("_weight")
            residuals = scored.select("row_id", F.transform("scores", hit).alias("r"))
            entries = _entries(rows).join(residuals, "row_id")
            sums = entries.groupBy("feature").agg(*[F.sum(F.col("value") * F.get("r", F.lit(i))).alias(f"g{i}") for i in range(k)])
            g = F.array(*[F.col(f"g{i}") / F.lit(total) for i in range(k)])
            push = F.zip_with(g, "w", lambda a, w: F.lit(rate) * (a + F.lit(decay) * w))
            moved = self.weights.join(sums, "feature").withColumn(
                "m", F.zip_with("m", push, lambda m, a: F.lit(mu) * m + a)
            )
            whole = residuals.agg(*[F.sum(F.get("r", F.lit(i))) for i in range(k)]).head()  # one row
            speed = [mu * s + rate * g / total for s, g in zip(speed, whole)]
            self._keep(moved.select("feature", F.zip_with("w", "m", lambda w, m: w - m).alias("w"), "m"), step + 1)
            self.bias = [b - s for b, s in zip(self.bias, speed)]
        return self

    def _keep(self, weights: DataFrame, step: int) -> None:
        path = f"{self.repository}/weights/iter_{step:09d}"
        weights.write.mode("overwrite").parquet(path)
        self.weights = weights.sparkSession.read.parquet(path)

    def _scores(self, df: DataFrame) -> DataFrame:
        """The rows with ``scores`` instead of their features; rows without known features get the bias alone."""
        kept = [c for c in df.columns if c not in ("indices", "values")]
        met = _entries(df).join(self.weights.select("feature", "w"), "feature")
        sums = met.groupBy("row_id").agg(
            *[F.sum(F.col("value") * F.get("w", F.lit(i))).alias(f"z{i}") for i in range(self.nclasses)]
        )
        z = F.array(*[F.coalesce(F.col(f"z{i}"), F.lit(0.0)) + F.lit(b) for i, b in enumerate(self.bias)])
        return df.select(*kept).join(sums, "row_id", "left").select(*kept, _softmax(z).alias("scores"))

    def predict_proba(self, df: DataFrame) -> DataFrame:
        return self._scores(df)

    def predict(self, df: DataFrame) -> DataFrame:
        return self._scores(df).withColumn("pred", predicted_class("scores"))


def _entries(df: DataFrame) -> DataFrame:
    entries = df.select("row_id", F.inline(F.arrays_zip("indices", "values")))
    return entries.select("row_id", F.col("indices").alias("feature"), F.col("values").alias("value"))


def _softmax(z: Column) -> Column:
    e = F.transform(z, lambda v: F.exp(v - F.array_max(z)))
    total = F.aggregate(e, F.lit(0.0), lambda s, v: s + v)
    return F.transform(e, lambda v: v / total)
