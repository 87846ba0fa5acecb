"""Networks whose first layer is a table: for more features than a broadcast may carry, with every rule and minibatches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.functions.hashing import uniform_draws
from gradloom.functions.vectors import dense_to_sparse, predicted_class
from gradloom.operators.ordering import number_by_hash
from gradloom.plans.kernels import feature_names, sum_partials
from gradloom.plans.network import NetworkModel, batch_gradient, checked_classes, forward, softmax
from gradloom.plans.repository import RunFolder, latest_path, load_arrays
from gradloom.plans.solver import SolverConfig, SolverState, solver_step
from gradloom.plans.training import log_rows
from gradloom.session import map_arrow, scratch_path

# The moment arrays that each update rule keeps.
MOMENTS = {"SGD": ["velocity"], "NESTEROV": ["velocity"], "ADAGRAD": ["square"], "RMSPROP": ["square"],
           "ADADELTA": ["square", "change"], "ADAM": ["first", "second"]}


class GivenSums:
    """Stands for a batch whose products with the first layer are known; keeps what is to be propagated back."""

    def __init__(self, sums: np.ndarray):
        self.sums, self.delta = sums, None

    def times(self, w: np.ndarray) -> np.ndarray:
        return self.sums

    def transposed_times(self, delta: np.ndarray) -> np.ndarray:
        self.delta = delta
        return np.zeros((0, delta.shape[1]))


class WideNetwork:
    """A multilayer perceptron, or with ``layers=()`` softmax or linear regression, on ``row_id`` rows, dense or sparse.

    The first layer lies in a table by feature, next to the moments of the update rule; layers above it are small and lie on
    the driver. Entries are cached in the partitions of their features and rows in those of their ids, once. A step moves
    two things: the sums of value times weight from features to rows, and the sums of value times residual from rows to
    features, both added up in map tasks first. Every step writes the table to ``repository``, which cuts the lineage; the
    table before goes unless it belongs to a snapshot.

    ``repository`` also holds snapshots and log, as that of ``NeuralNetwork`` does. ``resume`` goes on from the latest
    snapshot, with its moments; features that come new get first weights then.
    """

    def __init__(
        self, outputs: int, layers: Sequence[int] = (), activation: str = "relu", dropout: float = 0.0, regression: bool = False,
        repository: str = "", seed: int = 0, resume: bool = False, name: str = "",
    ):
        self.model = NetworkModel.initial(0, outputs, layers, activation, regression, seed)
        self.dropout, self.repository, self.seed, self.resume, self.name = dropout, repository, seed, resume, name
        self.run = ""
        self.state = SolverState()
        self.table: DataFrame | None = None  # feature, w and the moments, arrays as wide as the first layer
        self.losses: list[float] = []

    @property
    def hidden(self) -> int:
        """Width of the first layer."""
        return len(self.model.weights["b0"])

    # -- training -------------------------------------------------------------------------------------------------

    def fit(
        self, train: DataFrame, solver: SolverConfig | None = None, batch_size: int | None = None,
        class_weights: Sequence[float] | None = None, start: NetworkModel | None = None,
        validation_data: Sequence[DataFrame] = (), metrics: Sequence[str] = ("mcll", "accp"),
    ) -> WideNetwork:
        """Train; ``start`` gives the first weights, by default zeros or, with hidden layers, uniform draws by feature.

        ``losses`` holds the mean loss of every step. Rules, schedules, weight decay (not of biases), batches and dropout are those
        of ``NeuralNetwork``, and so are the weights, the snapshots and the rows of ``log()``.
        """
        solver = solver or SolverConfig()
        spark = train.sparkSession
        self.repository = self.repository or scratch_path(spark, "wide")
        folder = RunFolder(spark, self.repository)
        folder.append_call("fit", solver)
        if self.resume and self.table is None and folder.latest() is not None:
            self._load(folder)
        self.run = self.run or folder.start_run(self.name, solver.snapshot_prefix)
        checks = [v.withColumn("split", F.lit(f"val_{i}")).persist(StorageLevel.MEMORY_AND_DISK) for i, v in enumerate(validation_data, 1)]
        pending: list[tuple] = []
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows, batches = self._batched(train, solver, batch_size)
        rows = rows.repartition(parts, "row_id").persist(StorageLevel.MEMORY_AND_DISK)
        entries = rows.select("row_id", "batch_id", F.inline(F.arrays_zip("indices", "values"))).groupBy("indices", "row_id", "batch_id").agg(
            F.sum(F.col("values").cast("double")).alias("value")
        )
        entries = entries.withColumnRenamed("indices", "feature").repartition(parts, "feature").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            features = entries.select("feature").distinct()
            if self.table is None:
                self._keep(self._first(features, start, solver), 0)
            else:
                self._extend(features, solver)
            if start is not None:
                self.model.weights = {n: w for n, w in start.weights.items() if n != "w0"} | {"w0": self.model.weights["w0"]}
                self.model.weights = {n: self.model.weights[n] for n in start.weights}
            if checks and solver.test_initialization:
                pending += self._measure(checks, metrics)
            last, kept = self.state.step + solver.iterations, True
            while self.state.step < last:
                before = self._place
                self._step(rows, entries, solver, batches, class_weights, parts)
                if not kept:
                    self._drop(spark, before)
                done = self.state.step
                pending.append((self.run, float(done), "train", "train_loss", self.losses[-1]))
                if checks and (done == last or solver.test_interval and done % solver.test_interval == 0):
                    pending += self._measure(checks, metrics)
                kept = bool(done == last or solver.snapshot and done % solver.snapshot == 0)
                if kept:
                    moments = {f"state.{k}": v for k, v in self.state.moments.items()}
                    folder.save_snapshot(done, {**self.model.weights, **moments, "state.step": np.array([float(done)])}, self.run)
                    folder.append_log(pending)
                    pending = []
        finally:
            for held in (rows, entries, *checks):
                held.unpersist()
        return self

    def log(self) -> DataFrame:
        """``log``, ``iteration``, ``split``, ``metric``, ``value`` of this run."""
        return RunFolder(self.table.sparkSession, self.repository).log().where(F.col("log") == self.run)

    def _measure(self, checks: Sequence[DataFrame], metrics: Sequence[str]) -> list[tuple]:
        # Row ids may stand in several sets, so each is scored by itself.
        scored = reduce(DataFrame.unionByName, [self.predict_proba(v) for v in checks])
        return log_rows(scored, self.run, self.state.step, metrics, None if self.model.regression else self.model.outputs)

    def _load(self, folder: RunFolder) -> None:
        """The latest snapshot: what lies on the driver, and the table written at that step."""
        path = latest_path(folder)
        self.run, step = folder.latest()
        arrays = load_arrays(folder.spark, path)
        self.model.weights = {n: arrays[n] for i in range(self.model.depth) for n in (f"w{i}", f"b{i}")}
        self.state = SolverState(int(arrays["state.step"][0]), {n[6:]: a for n, a in arrays.items() if n.startswith("state.") and n != "state.step"})
        self._place = self._table_path(step)
        self.table = folder.spark.read.parquet(self._place)

    def _extend(self, features: DataFrame, solver: SolverConfig) -> None:
        """First weights for features that the table lacks."""
        new = features.join(self.table, "feature", "left_anti")
        if new.head(1):
            table = self.table.unionByName(self._first(new, None, solver))
            self._keep(table, self.state.step, "extended/")

    def _table_path(self, step: int, folder: str = "") -> str:
        return f"{self.repository}/first_layer/{self.run}/{folder}iter_{step:09d}"

    def _drop(self, spark, place: str) -> None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _batched(self, train: DataFrame, solver: SolverConfig, batch_size: int | None) -> tuple[DataFrame, int]:
        answer = "targets" if self.model.regression else "label"
        rows = train.select("row_id", answer, *feature_names(train))
        rows = dense_to_sparse(rows) if "features" in rows.columns else rows
        if not batch_size:
            return rows.withColumn("batch_id", F.lit(0).cast("bigint")), 1
        taken = batch_size * solver.iter_size
        batches = max(1, -(-rows.count() // taken))
        if batches == 1:
            return rows.withColumn("batch_id", F.lit(0).cast("bigint")), 1
        placed = number_by_hash(rows, self.seed, out="_place")
        return placed.withColumn("batch_id", F.floor(F.col("_place") / F.lit(taken))).drop("_place"), batches

    def _first(self, features: DataFrame, start: NetworkModel | None, solver: SolverConfig) -> DataFrame:
        """The table before the first step."""
        width, moments = self.hidden, MOMENTS[solver.solver_type]
        given = None if start is None else features.sparkSession.sparkContext.broadcast(start.weights["w0"])
        bound = float(np.sqrt(6.0 / (width + (self.model.layers[1] if len(self.model.layers) > 1 else self.model.outputs)))) if self.model.layers else 0.0
        seed = self.seed

        def make(batches):
            for batch in batches:
                ids = batch.column("feature").to_numpy()
                if given is None:
                    w = (2.0 * uniform_draws(seed, 0, ids, width) - 1.0) * bound
                else:
                    w = given.value[ids]
                zero = _lists(np.zeros((len(ids), width)))
                yield pa.RecordBatch.from_arrays([batch.column("feature"), _lists(w), *[zero for _ in moments]], names=["feature", "w", *moments])

        return map_arrow(features, make, self._schema(features.schema["feature"].dataType, moments))

    def _schema(self, kind: T.DataType, moments: Sequence[str]) -> T.StructType:
        schema = T.StructType([T.StructField("feature", kind)])
        for name in ("w", *moments):
            schema = schema.add(name, T.ArrayType(T.DoubleType()))
        return schema

    def _keep(self, table: DataFrame, step: int, folder: str = "") -> None:
        self._place = self._table_path(step, folder)
        table.write.mode("overwrite").parquet(self._place)
        self.table = table.sparkSession.read.parquet(self._place)

    def _sums(self, entries: DataFrame, parts: int) -> DataFrame:
        """row_id and z, the products of its entries with the first layer."""
        met = entries.join(self.table.select("feature", "w").repartition(parts, "feature"), "feature")
        products = met.groupBy("row_id").agg(*[F.sum(F.col("value") * F.get("w", F.lit(i))).alias(f"z{i}") for i in range(self.hidden)])
        return products.select("row_id", F.array(*[f"z{i}" for i in range(self.hidden)]).alias("z"))

    def _step(self, rows: DataFrame, entries: DataFrame, solver: SolverConfig, batches: int, class_weights, parts: int) -> None:
        step = self.state.step
        chosen = F.col("batch_id") == step % batches
        z = self._sums(entries.where(chosen), parts)
        met = rows.where(chosen).join(z, "row_id", "left").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kernel = self._kernel(class_weights, step)
            loss, weight, total = sum_partials(met.drop("indices", "values"), lambda b: kernel(b, False), parts, self.model.size)
            scale = 1.0 / weight if weight else 0.0
            self.losses.append(loss * scale)
            sums = map_arrow(met, lambda b: kernel(b, True), f"feature {_kind(self.table)}, g array<double>")
            width = self.hidden
            added = sums.groupBy("feature").agg(*[F.sum(F.get("g", F.lit(i))).alias(f"g{i}") for i in range(width)])
            gradient = F.array(*[F.col(f"g{i}") * F.lit(scale) for i in range(width)])
            self._update(added.select("feature", gradient.alias("g")), solver)
        finally:
            met.unpersist()
        gradients = self.model.unflatten(total * scale)
        if solver.weight_decay:
            for i in range(1, self.model.depth):
                gradients[f"w{i}"] = gradients[f"w{i}"] + solver.weight_decay * self.model.weights[f"w{i}"]
        self.model.weights = solver_step(solver, self.state, self.model.weights, gradients)
        self._keep(self._moved, self.state.step)

    def _kernel(self, class_weights, step: int):
        """Per batch of rows: the gradient of the upper layers, or what each feature's gradient gets from these rows."""
        model, dropout, seed = self.model, self.dropout, self.seed
        by_class = None if class_weights is None else np.asarray(class_weights, np.float64)
        shipped = self.table.sparkSession.sparkContext.broadcast(model)

        def gradients(batches):
            held = shipped.value
            width = len(held.weights["b0"])
            for batch in batches:
                if not batch.num_rows:
                    continue
                column = batch.column("z")
                sums = np.zeros((batch.num_rows, width))
                known = np.asarray(column.is_valid())
                sums[known] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                if held.regression:
                    answers = batch.column("targets").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, held.outputs)
                else:
                    answers = checked_classes(batch.column("label").to_numpy(zero_copy_only=False), held.outputs)
                weights = np.ones(batch.num_rows) if by_class is None or held.regression else by_class[answers]
                masks = None
                if dropout and held.layers:
                    ids = batch.column("row_id").to_numpy(zero_copy_only=False)
                    kept = (uniform_draws(seed, step, ids, sum(held.layers)) >= dropout) / (1.0 - dropout)
                    masks = np.split(kept, np.cumsum(held.layers)[:-1], axis=1)
                x = GivenSums(sums)
                loss, found = batch_gradient(held, x, answers, weights, masks)
                yield batch, x.delta, loss, weights.sum(), found

        def upper(batches):
            total, weight, loss = np.zeros(model.size), 0.0, 0.0
            for _, _, part, w, found in gradients(batches):
                loss, weight = loss + part, weight + w
                total += np.concatenate([found[n].ravel() for n in model.weights])
            return (loss, weight, total) if weight else None

        def by_feature(batches):
            for batch, delta, *_ in gradients(batches):
                lists = batch.column("indices")
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                values = np.asarray(batch.column("values").flatten().to_numpy(zero_copy_only=False), np.float64)
                row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                order = np.argsort(ids, kind="stable")
                ids, pushed = ids[order], values[order][:, None] * delta[row[order]]
                heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
                if len(heads):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[heads]), _lists(np.add.reduceat(pushed, heads, axis=0))], names=["feature", "g"])

        return lambda batches, features: by_feature(batches) if features else upper(batches)

    def _update(self, gradient: DataFrame, solver: SolverConfig) -> None:
        """One step of the rule for every feature; those without an entry in the batch have a gradient of 0."""
        moments, step, width = MOMENTS[solver.solver_type], self.state.step, self.hidden
        met = self.table.join(gradient, "feature", "left")

        def move(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                held = {n: batch.column(n).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for n in ("w", *moments)}
                g = np.zeros((batch.num_rows, width))
                g[np.asarray(batch.column("g").is_valid())] = batch.column("g").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                g = g + (solver.weight_decay or 0.0) * held["w"]
                state = SolverState(step, {f"{n}.w0": held[n] for n in moments})
                moved = solver_step(solver, state, {"w0": held["w"]}, {"w0": g})["w0"]
                kept = [_lists(state.moments.get(f"{n}.w0", held[n])) for n in moments]
                yield pa.RecordBatch.from_arrays([batch.column("feature"), _lists(moved), *kept], names=["feature", "w", *moments])

        self._moved = map_arrow(met, move, self._schema(self.table.schema["feature"].dataType, moments))

    # -- scoring ----------------------------------------------------------------------------------------------------

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """The rows with ``scores`` instead of their features; features never trained on have weight 0."""
        if self.table is None:
            self._load(RunFolder(df.sparkSession, self.repository))
        kept = [c for c in df.columns if c not in ("features", "indices", "values")]
        rows = dense_to_sparse(df) if "features" in df.columns else df
        entries = rows.select("row_id", F.inline(F.arrays_zip("indices", "values")))
        entries = entries.select("row_id", F.col("indices").alias("feature"), F.col("values").cast("double").alias("value"))
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        met = df.select(*kept).join(self._sums(entries, parts), "row_id", "left").select(*kept, "z")
        shipped = df.sparkSession.sparkContext.broadcast(self.model)

        def score(batches):
            held = shipped.value
            width = len(held.weights["b0"])
            for batch in batches:
                sums = np.zeros((batch.num_rows, width))
                sums[np.asarray(batch.column("z").is_valid())] = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                out, _ = forward(held, GivenSums(sums))
                out = out if held.regression else softmax(out)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], _lists(out)], names=[*kept, "scores"])

        return map_arrow(met, score, df.select(*kept).schema.add("scores", T.ArrayType(T.DoubleType())))

    def predict(self, df: DataFrame) -> DataFrame:
        return self.predict_proba(df).withColumn("pred", predicted_class("scores"))


def _lists(table: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(0, table.size + 1, max(table.shape[1], 1), dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(table, np.float64).ravel()))


def _kind(table: DataFrame) -> str:
    return table.schema["feature"].dataType.simpleString()
