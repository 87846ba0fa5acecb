"""Estimators trained by gradient iterations: softmax or linear regression and multilayer perceptrons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.functions.vectors import predicted_class
from gradloom.operators.metrics import confusion_matrix, evaluate_sets, with_prediction
from gradloom.operators.ordering import number_by_hash
from gradloom.operators.prepare import validation_bundle
from gradloom.plans.kernels import feature_names, feature_width
from gradloom.plans.network import NetworkModel, network_gradient, network_scores
from gradloom.plans.repository import RunFolder, latest_path, load_arrays
from gradloom.plans.solver import SolverConfig, SolverState, solver_step
from gradloom.session import persist_balanced, scratch_path


def measure(scored: DataFrame, metrics: Sequence[str], nclasses: int) -> list[tuple[str, str, float]]:
    """(split, metric, value) of scored sets; the rows are scored once unless a ranking metric asks again."""
    confusion = confusion_matrix(with_prediction(scored)).persist()
    try:
        return sorted(tuple(r) for r in evaluate_sets(scored, metrics, nclasses, confusion).collect())
    finally:
        confusion.unpersist()


# Minibatches are cached up to this size; larger sets are stored by groups of batches.
CACHED_BATCH_BYTES = 4 * 1024**3
# Rows (in bytes) that one task should find, in a cached table and in a stored group of batches.
PARTITION_BYTES = 64 * 1024**2
GROUP_BYTES = 1024**3


def log_rows(scored: DataFrame, run: str, iteration: int, metrics: Sequence[str], nclasses: int | None) -> list[tuple]:
    """The log rows of scored validation sets; without classes the mean of half the squared error."""
    if nclasses is None:
        error = F.aggregate(F.zip_with("scores", "targets", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, e: s + e)
        found = [(r[0], "loss", r[1]) for r in scored.groupBy("split").agg(F.avg(error / 2.0)).collect()]
    else:
        found = measure(scored, metrics, nclasses)
    return [(run, float(iteration), split, metric, value) for split, metric, value in found]


@dataclass
class TrainingRows:
    """Rows an estimator goes over again and again."""

    table: DataFrame
    parts: int
    batches_per_group: int | None = None

    @classmethod
    def cached(cls, rows: DataFrame, width: int, size: int | None = None) -> TrainingRows:
        """Kept in executor memory, spilling to their disks.

        Batches of known size lie in the order of their numbers, so a step reads the cached blocks of its batch only.
        """
        if size is not None:
            rows = rows.repartitionByRange(max(1, size // PARTITION_BYTES), "batch_id").sortWithinPartitions("batch_id")
        return cls(*persist_balanced(rows, 8 * width))

    @classmethod
    def stored(cls, rows: DataFrame, size: int, steps: int, path: str) -> TrainingRows:
        """Written to one folder per group of batches, so that an iteration opens its own files only."""
        per_group = max(1, steps * GROUP_BYTES // size)
        grouped = rows.withColumn("batch_group", F.floor(F.col("batch_id") / F.lit(per_group)))
        grouped.repartitionByRange("batch_group", "batch_id").write.partitionBy("batch_group").parquet(path)
        parts = max(1, min(size, GROUP_BYTES) // PARTITION_BYTES) * 2
        return cls(rows.sparkSession.read.parquet(path), parts, per_group)

    def batch(self, number: int) -> DataFrame:
        chosen = F.col("batch_id") == number
        if self.batches_per_group:
            chosen &= F.col("batch_group") == number // self.batches_per_group
        return self.table.where(chosen)


class NeuralNetwork:
    """Multilayer perceptron with hidden ``layers``; ``layers=()`` is softmax (or linear) regression.

    ``repository`` is a folder all executors reach; snapshots, log and calls are kept there. ``resume`` goes on
    from its latest snapshot; ``weights`` names one snapshot to start (or just score) from.
    """

    def __init__(
        self,
        nclasses: int | None = None,
        ntargets: int | None = None,
        layers: Sequence[int] = (100,),
        activation: str = "relu",
        dropout: float = 0.5,
        regression: bool = False,
        repository: str = "",
        resume: bool = False,
        finetuning: bool = False,
        weights: str = "",
        name: str = "",
        seed: int = 0,
    ):
        if (ntargets if regression else nclasses) is None:
            raise ValueError("regression needs ntargets, classification needs nclasses")
        self.nclasses, self.ntargets, self.regression = nclasses, ntargets, regression
        self.layers, self.activation, self.dropout = tuple(layers), activation, dropout
        self.repository, self.resume, self.finetuning, self.weights = repository, resume, finetuning, weights
        self.name, self.seed = name, seed
        self.model: NetworkModel | None = None
        self.state = SolverState()

    # -- training ---------------------------------------------------------------------------------------------

    def fit(
        self,
        train: DataFrame,
        validation_data: Sequence[DataFrame] = (),
        solver: SolverConfig | None = None,
        batch_size: int | None = 128,
        class_weights: Sequence[float] | None = None,
        metrics: Sequence[str] = ("mcll", "accp"),
        display_metric_interval: int = 1,
    ) -> DataFrame:
        """Train and return the log: ``log``, ``iteration``, ``split``, ``metric``, ``value``.

        ``batch_size=None`` takes all rows at every iteration. With batches, only the rows that the planned
        iterations visit are kept, in the seeded hash order of their ids.
        """
        solver = solver or SolverConfig()
        spark = train.sparkSession
        folder = self._folder(spark)
        folder.append_call("fit", solver)
        going_on = self._start(folder, train)
        run = going_on or folder.start_run(self.name, solver.snapshot_prefix)

        rows, batches = self._prepare(train, solver, batch_size)
        checks = validation_bundle(validation_data)
        if checks is not None:
            checks = checks.persist(StorageLevel.MEMORY_AND_DISK)

        pending: list[tuple] = []
        try:
            if checks is not None and solver.test_initialization:
                pending += self._measure(run, self.state.step, checks, metrics)
            last = self.state.step + solver.iterations
            while self.state.step < last:
                step = self.state.step
                batch = rows.table if batches == 1 else rows.batch(step % batches)
                loss, _, gradients = network_gradient(
                    batch, self.model, rows.parts, class_weights, self.dropout, self.seed, step
                )
                if solver.weight_decay:
                    for i in range(self.model.depth):
                        gradients[f"w{i}"] = gradients[f"w{i}"] + solver.weight_decay * self.model.weights[f"w{i}"]
                self.model.weights = solver_step(solver, self.state, self.model.weights, gradients)
                done = self.state.step
                if done % display_metric_interval == 0 or done == last:
                    pending.append((run, float(done), "train", "train_loss", loss))
                tested = solver.test_interval and done % solver.test_interval == 0
                if checks is not None and (tested or done == last):
                    pending += self._measure(run, done, checks, metrics)
                if solver.snapshot and done % solver.snapshot == 0 or done == last:
                    folder.save_snapshot(done, self._arrays(), run)
                    folder.append_log(pending)
                    pending = []
        finally:
            rows.table.unpersist()
            if checks is not None:
                checks.unpersist()
        return folder.log().where(F.col("log") == run)

    def _folder(self, spark: SparkSession) -> RunFolder:
        if not self.repository:
            self.repository = scratch_path(spark, "model")
        return RunFolder(spark, self.repository)

    def _start(self, folder: RunFolder, train: DataFrame) -> str | None:
        """Fresh weights, or those of the named or latest snapshot; the run that goes on, if one does."""
        latest = folder.latest() if self.resume or self.finetuning else None
        if self.weights or latest is not None:
            path = self.weights or folder.snapshot_path(latest[1], latest[0])
            self._restore(load_arrays(folder.spark, path), keep_state=self.resume)
            return latest[0] if self.resume and not self.weights else None
        outputs = self.ntargets if self.regression else self.nclasses
        self.model = NetworkModel.initial(
            feature_width(train), outputs, self.layers, self.activation, self.regression, self.seed
        )
        self.state = SolverState()
        return None

    def _prepare(self, train: DataFrame, solver: SolverConfig, batch_size: int | None):
        """The training rows and the number of batches they are cut into."""
        wanted = ["targets" if self.regression else "label", *feature_names(train)]
        if "row_id" in train.columns:
            wanted.insert(0, "row_id")
        rows = train.select(*wanted)
        if not batch_size:
            return TrainingRows.cached(rows, self.model.width), 1
        total, taken = rows.count(), batch_size * solver.iter_size
        batches = max(1, -(-total // taken))
        if batches == 1:
            return TrainingRows.cached(rows, self.model.width), 1
        # Iterations wrap around after `batches` steps; rows no planned iteration visits are not kept.
        first, steps = self.state.step % batches, min(solver.iterations, batches)
        last = first + steps
        wanted = [(first * taken, last * taken)] + ([(0, (last - batches) * taken)] if last > batches else [])
        visited = number_by_hash(rows, self.seed, out="_place", wanted=wanted)
        visited = visited.withColumn("batch_id", F.floor(F.col("_place") / F.lit(taken))).drop("_place")
        size = steps * taken * self.model.width * 8
        if size <= CACHED_BATCH_BYTES:
            return TrainingRows.cached(visited, self.model.width, size), batches
        return TrainingRows.stored(visited, size, steps, scratch_path(train.sparkSession, "batches")), batches

    def _measure(self, run: str, iteration: int, checks: DataFrame, metrics: Sequence[str]) -> list[tuple]:
        return log_rows(network_scores(checks, self.model), run, iteration, metrics, None if self.regression else self.nclasses)

    # -- state ------------------------------------------------------------------------------------------------

    def _arrays(self) -> dict[str, np.ndarray]:
        moments = {f"state.{k}": v for k, v in self.state.moments.items()}
        return {**self.model.weights, **moments, "state.step": np.array([float(self.state.step)])}

    def _restore(self, arrays: dict[str, np.ndarray], keep_state: bool) -> None:
        weights = {n: a for n, a in sorted(arrays.items()) if not n.startswith("state.")}
        depth = len(weights) // 2
        weights = {n: weights[n] for i in range(depth) for n in (f"w{i}", f"b{i}")}
        layers = tuple(weights[f"b{i}"].size for i in range(depth - 1))
        self.model = NetworkModel(
            weights["w0"].shape[0], weights[f"b{depth - 1}"].size, layers, self.activation, self.regression, weights
        )
        self.layers = layers
        self.state = SolverState()
        if keep_state:
            self.state.step = int(arrays["state.step"][0])
            self.state.moments = {n[6:]: a for n, a in arrays.items() if n.startswith("state.") and n != "state.step"}

    # -- scoring ----------------------------------------------------------------------------------------------

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """The rows with a ``scores`` array instead of their features; lazy, no shuffle."""
        if self.model is None:
            spark = df.sparkSession
            folder = RunFolder(spark, self.repository)
            path = self.weights or latest_path(folder)
            self._restore(load_arrays(spark, path), keep_state=False)
        return network_scores(df, self.model)

    def predict(self, df: DataFrame) -> DataFrame:
        """``pred`` next to the scores: the most probable class."""
        return self.predict_proba(df).withColumn("pred", predicted_class("scores"))


class SoftmaxRegression(NeuralNetwork):
    """Multinomial logistic regression, or linear regression with ``regression=True``; no hidden layers."""

    def __init__(self, nclasses: int | None = None, ntargets: int | None = None, **options):
        super().__init__(nclasses, ntargets, layers=(), dropout=0.0, **options)
