"""The boosted estimator: trees, trees with dropout, or a linear model behind one interface."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradloom.functions.vectors import predicted_class
from gradloom.operators.prepare import validation_bundle
from gradloom.plans import objectives
from gradloom.plans.boosting import BoosterParams, TreeEnsemble, ensemble_scores, train_trees
from gradloom.plans.linear_boosting import LinearEnsemble, linear_scores, train_linear
from gradloom.plans.repository import RunFolder, latest_path, load_arrays
from gradloom.plans.training import measure
from gradloom.session import scratch_path


class BoostedModel:
    def __init__(self, nclasses: int = 2, repository: str = "", name: str = "", resume: bool = False, weights: str = ""):
        self.nclasses, self.repository, self.name = nclasses, repository, name
        self.resume, self.weights = resume, weights
        self.model: TreeEnsemble | LinearEnsemble | None = None

    def fit(
        self,
        train: DataFrame,
        validation_data: Sequence[DataFrame] = (),
        objective: str = "multi:softprob",
        booster: str = "gbtree",
        eval_metric: str = "auc",
        base_score: float = 0.5,
        seed: int = 0,
        nthread: int = -1,
        iterations: int = 10,
        test_interval: int = 1,
        save_period: int = 0,
        metrics: Sequence[str] = ("auc", "acc"),
        **booster_params,
    ) -> DataFrame:
        """Train and return the log: the metrics of the validation sets, or without any the training loss.

        Training starts from the snapshot that ``weights`` names, with ``resume`` from the latest one, else afresh.
        ``nthread`` has no effect: Spark decides how many tasks run.
        """
        if booster not in objectives.BOOSTERS:
            raise ValueError(f"booster {booster!r} is not one of {objectives.BOOSTERS}")
        p = BoosterParams.of(booster_params)
        spark = train.sparkSession
        self.repository = self.repository or scratch_path(spark, "model")
        folder = RunFolder(spark, self.repository)
        folder.append_call("fit", {"objective": objective, "booster": booster, "iterations": iterations, **booster_params})
        latest = folder.latest() if self.resume and not self.weights else None
        self.model = None
        if self.weights or latest is not None:
            self._load(folder)
        run = latest[0] if latest else folder.start_run(self.name)
        begun = latest[1] if latest else 0
        own = train.select(*[c for c in train.columns if c not in ("split", "targets")]).withColumn("split", F.lit("train"))
        wanted = tuple(dict.fromkeys([*metrics, eval_metric]))
        checks = validation_bundle(validation_data)
        if checks is not None:
            checks = checks.persist(StorageLevel.MEMORY_AND_DISK)
        done, pending = begun, []

        def after_round(model, scored=None, loss=None) -> None:
            nonlocal done, pending
            done += 1
            last = done == begun + iterations
            self.model = model
            if last or test_interval and done % test_interval == 0:
                if checks is not None:
                    rows = scored() if scored is not None else self.predict_proba(checks)
                    pending += [(run, float(done), s, m, v) for s, m, v in self._measure(rows, wanted)]
                else:
                    found = loss() if loss is not None else self._measure(self.predict_proba(own), ("mcll",))
                    pending += [(run, float(done), s, "train_loss", v) for s, _, v in found]
            if last or save_period and done % save_period == 0:
                folder.save_snapshot(done, model.arrays(), run)
                folder.append_log(pending)
                pending = []

        try:
            if booster == "gblinear":
                train_linear(train, objective, self.nclasses, iterations, base_score, seed, p, self.model, after_round)
            else:
                train_trees(train, objective, booster, self.nclasses, iterations, base_score, seed, p, self.model, after_round, checks)
        finally:
            if checks is not None:
                checks.unpersist()
        return folder.log().where(F.col("log") == run)

    def _measure(self, scored: DataFrame, metrics: Sequence[str]):
        if self.model.objective.startswith("reg:"):
            error = (F.get("scores", F.lit(0)) - F.col("label")) ** 2
            return [(r[0], "loss", r[1]) for r in scored.groupBy("split").agg(F.avg(error / 2.0)).collect()]
        return measure(scored, metrics, self.nclasses)

    def _load(self, folder: RunFolder) -> None:
        arrays = load_arrays(folder.spark, self.weights or latest_path(folder))
        linear = "linear.weights" in arrays
        self.model = LinearEnsemble.from_arrays(arrays) if linear else TreeEnsemble.from_arrays(arrays)

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """``scores`` per row: class probabilities, or one number for the regression objectives."""
        if self.model is None:
            self._load(RunFolder(df.sparkSession, self.repository))
        if isinstance(self.model, LinearEnsemble):
            return linear_scores(df, self.model)
        return ensemble_scores(df, self.model)

    def predict(self, df: DataFrame) -> DataFrame:
        scored = self.predict_proba(df)
        if self.model.objective.startswith("reg:"):
            return scored.withColumn("pred", F.get("scores", F.lit(0)))
        return scored.withColumn("pred", predicted_class("scores"))
