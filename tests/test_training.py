import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradloom.functions.hashing import uniform_draws
from gradloom.functions.vectors import dense_to_sparse
from gradloom.plans import kernels, training
from gradloom.plans.booster import BoostedModel
from gradloom.plans.kernels import Dense, Sparse
from gradloom.plans.network import NetworkModel, batch_gradient, network_gradient
from gradloom.plans.repository import RunFolder
from gradloom.plans.solver import RULES, SolverConfig, SolverState, solver_step
from gradloom.plans.training import NeuralNetwork, SoftmaxRegression
from gradloom.plans.wide_softmax import WideSoftmaxRegression
from gradloom.sources.svmlight import read_svmlight, write_svmlight
from gradloom.sources.tables import from_dense

pytestmark = pytest.mark.filterwarnings("ignore")


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return from_dense(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding", "vec_id", "label").persist()


def accuracy(model, rows):
    return model.predict(rows).agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).head()[0]


def test_numeric_gradient():
    rng = np.random.default_rng(4)
    for activation, regression in (("tanh", False), ("sigmoid", True), ("relu", False)):
        model = NetworkModel.initial(5, 3, (4, 3), activation, regression, seed=2)
        x = pa.RecordBatch.from_pydict({"features": list(rng.normal(size=(7, 5)))})
        answers = rng.normal(size=(7, 3)) if regression else rng.integers(0, 3, 7)
        weights = rng.random(7)
        _, gradients = batch_gradient(model, Dense(x, 5), answers, weights)
        for name, array in model.weights.items():
            at = tuple(s // 2 for s in array.shape)
            losses = []
            for step in (1e-6, -1e-6):
                array[at] += step
                losses.append(batch_gradient(model, Dense(x, 5), answers, weights)[0])
                array[at] -= step
            assert gradients[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-6)


def test_sparse_products_equal_dense():
    rng = np.random.default_rng(1)
    x = np.where(rng.random((6, 8)) < 0.5, rng.normal(size=(6, 8)), 0.0)
    x[2] = 0.0
    dense = Dense(pa.RecordBatch.from_pydict({"features": list(x)}), 8)
    columns = {"indices": [np.flatnonzero(r).astype(np.int32) for r in x], "values": [r[r != 0] for r in x]}
    sparse = Sparse(pa.RecordBatch.from_pydict(columns), 8)
    w, r = rng.normal(size=(8, 3)), rng.normal(size=(6, 3))
    for name, arg in (("times", w), ("transposed_times", r), ("squared_transposed_times", r)):
        assert getattr(dense, name)(arg) == pytest.approx(getattr(sparse, name)(arg))
    narrow = Sparse(pa.RecordBatch.from_pydict(columns), 5)
    assert narrow.times(w[:5]) == pytest.approx(x[:, :5] @ w[:5])


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_gradient_does_not_depend_on_partitions(rows, parts, monkeypatch):
    """Also with the second level of adding up, which small limits bring about."""
    model = NetworkModel.initial(64, 10, (8,), seed=3)
    loss, weight, expected = network_gradient(rows.coalesce(1), model, 1, dropout=0.5, seed=1, iteration=2)
    split = rows.repartition(parts)
    for limit, values, fan in ((kernels.DRIVER_BYTES, kernels.SLICE_VALUES, 64), (3 * 8 * model.size, 100, 64), (8, 77, 2)):
        monkeypatch.setattr(kernels, "DRIVER_BYTES", limit)
        monkeypatch.setattr(kernels, "SLICE_VALUES", values)
        monkeypatch.setattr(kernels, "FAN_IN", fan)
        got = network_gradient(split, model, parts, dropout=0.5, seed=1, iteration=2)
        assert got[0] == pytest.approx(loss, abs=1e-9) and got[1] == weight
        for name in expected:
            assert got[2][name] == pytest.approx(expected[name], abs=1e-9)


def test_sparse_and_dense_train_alike(rows):
    solver = SolverConfig(iterations=3, base_lr=0.5, momentum=0.9)
    dense = SoftmaxRegression(10)
    dense.fit(rows, solver=solver, batch_size=100)
    sparse = SoftmaxRegression(10)
    sparse.fit(dense_to_sparse(rows), solver=solver, batch_size=100)
    assert sparse.model.weights["w0"] == pytest.approx(dense.model.weights["w0"], abs=1e-12)


def test_minibatches_cached_or_stored(rows, monkeypatch):
    """Seven steps of 60 rows over a set of nine batches, then on to a second epoch by resuming."""
    solver = SolverConfig(iterations=7, base_lr=0.5)
    models = []
    for limit in (training.CACHED_BATCH_BYTES, 0):
        monkeypatch.setattr(training, "CACHED_BATCH_BYTES", limit)
        monkeypatch.setattr(training, "GROUP_BYTES", 64 * 60 * 8 * 2)
        first = SoftmaxRegression(10)
        first.fit(rows, solver=solver, batch_size=60)
        more = SoftmaxRegression(10, repository=first.repository, resume=True)
        more.fit(rows, solver=solver, batch_size=60)
        models.append(more.model.weights["w0"])
    straight = SoftmaxRegression(10)
    straight.fit(rows, solver=SolverConfig(iterations=14, base_lr=0.5), batch_size=60)
    assert models[0] == pytest.approx(models[1], abs=1e-12)
    assert models[0] == pytest.approx(straight.model.weights["w0"], abs=1e-12)


def test_update_rules_reach_a_minimum():
    rates = {"SGD": 0.1, "NESTEROV": 0.1, "ADAGRAD": 0.5, "RMSPROP": 0.05, "ADADELTA": 30.0, "ADAM": 0.1}
    for rule in RULES:
        config, state = SolverConfig(solver_type=rule, base_lr=rates[rule], momentum=0.5 if rule in ("SGD", "NESTEROV") else None), SolverState()
        weights = {"w": np.array([3.0, -2.0])}
        for _ in range(400):
            weights = solver_step(config, state, weights, {"w": weights["w"] - 1.0})
        assert weights["w"] == pytest.approx([1.0, 1.0], abs=0.1), rule
    with pytest.raises(ValueError):
        solver_step(SolverConfig(solver_type="LBFGS"), SolverState(), {}, {})


@pytest.mark.parametrize("rule", ["ADAM", "NESTEROV"])
def test_resume_equals_straight_run(rows, rule):
    def config(n):
        return SolverConfig(iterations=n, base_lr=0.02, solver_type=rule, momentum=0.9, snapshot=2)

    options = {"layers": (8,), "dropout": 0.3, "seed": 5}
    straight = NeuralNetwork(10, **options)
    straight.fit(rows, solver=config(5), batch_size=None)
    first = NeuralNetwork(10, **options)
    first.fit(rows, solver=config(2), batch_size=None)
    second = NeuralNetwork(10, repository=first.repository, resume=True, **options)
    second.fit(rows, solver=config(3), batch_size=None)
    for name, w in straight.model.weights.items():
        assert second.model.weights[name] == pytest.approx(w, abs=1e-12)
    folder = RunFolder(rows.sparkSession, second.repository)
    assert folder.latest_iteration() == 5
    assert {r.iteration for r in folder.snapshots().select("iteration").distinct().collect()} == {2, 4, 5}
    assert folder.calls().count() == 2


def test_mlp_learns_and_reloads_exactly(rows):
    model = NeuralNetwork(10, layers=[50], name="net")
    solver = SolverConfig(iterations=60, base_lr=0.02, solver_type="ADAM", test_interval=30)
    log = model.fit(rows, [rows], solver, batch_size=None, metrics=["mcll", "accp", "f1"])
    assert accuracy(model, rows) > 0.7
    assert {r.iteration for r in log.where("split = 'val_1'").select("iteration").distinct().collect()} == {0.0, 30.0, 60.0}
    again = NeuralNetwork(10, repository=model.repository, finetuning=True)
    before, after = (m.predict(rows).select("row_id", "pred", "scores") for m in (model, again))
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_regression_learns(spark):
    df = spark.range(500).select(F.array((F.col("id") % 17) / 17.0, (F.col("id") % 5) / 5.0).alias("features")).withColumn(
        "targets", F.array(2.0 * F.get("features", F.lit(0)) - F.get("features", F.lit(1)) + 0.5)
    )
    model = SoftmaxRegression(ntargets=1, regression=True)
    log = model.fit(df, [df], SolverConfig(iterations=150, base_lr=0.5, momentum=0.9), None)
    assert model.model.weights["w0"][:, 0] == pytest.approx([2.0, -1.0], abs=0.01)
    assert model.model.weights["b0"] == pytest.approx([0.5], abs=0.01)
    first, last = (log.where(f"iteration = {i} and metric = 'loss'").head().value for i in (0, 150))
    assert last < 1e-4 < first


def test_boosted_trees_learn_resume_and_reload(rows):
    model = BoostedModel(10)
    log = model.fit(rows, [rows], iterations=4, max_depth=3, test_interval=2, save_period=2, eval_metric="f1", metrics=["acc"])
    assert accuracy(model, rows) > 0.7
    assert {(r.iteration, r.metric) for r in log.select("iteration", "metric").collect()} == {(2.0, "acc"), (4.0, "acc"), (2.0, "f1"), (4.0, "f1")}
    again = BoostedModel(10, repository=model.repository)
    before, after = (m.predict(rows).select("row_id", "scores") for m in (model, again))
    assert before.exceptAll(after).count() == 0
    half = BoostedModel(10)
    half.fit(rows, iterations=2, max_depth=3)
    more = BoostedModel(10, repository=half.repository, resume=True)
    more.fit(rows, iterations=2, max_depth=3)
    assert more.predict(rows).select("row_id", "scores").exceptAll(after).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_trees_do_not_depend_on_partitions_or_refresh(spark, rows, parts, monkeypatch):
    """Stored margins, histogram passes and partitions change nothing about the trees."""
    from gradloom.plans import boosting

    def nodes(df):
        model = BoostedModel(10)
        model.fit(df, iterations=3, max_depth=2, subsample=0.7, colsample=0.5, seed=3)
        return [(t.feature, t.bin, np.round(t.value, 9).tolist()) for trees in model.model.rounds for t in trees]

    plain = nodes(rows)
    monkeypatch.setattr(boosting, "REFRESH_ROUNDS", 1)
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 16 * 64 * 64 * 7)
    assert nodes(rows.repartition(parts)) == plain


def test_boosting_against_brute_force(spark):
    """Exact greedy tree of depth two on few distinct values, grown in plain loops."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, size=(300, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(int)
    df = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "features array<double>, label int")
    model = BoostedModel(2)
    model.fit(df, objective="binary:logistic", iterations=1, max_depth=2)
    tree = model.model.rounds[0][0]

    def best(mask):
        g, h = 0.5 - y[mask], np.full(mask.sum(), 0.25)
        found = (0.0, None)
        for f in range(3):
            for cut in np.unique(x[mask, f])[:-1]:
                left = x[mask, f] <= cut
                parts = [(g[s].sum(), h[s].sum()) for s in (left, ~left, slice(None))]
                if min(parts[0][1], parts[1][1]) < 1:
                    continue
                gain = 0.5 * (sum(a * a / (b + 1) for a, b in parts[:2]) - parts[2][0] ** 2 / (parts[2][1] + 1))
                if gain > found[0] + 1e-12:
                    found = (gain, (f, cut))
        return found

    def check(node, mask):
        gain, split = best(mask)
        if node == 0 or tree.feature[node] >= 0:
            assert (tree.feature[node], tree.threshold[node]) == split
            assert tree.gain[node] == pytest.approx(gain)
            left = x[:, split[0]] <= split[1]
            return check(tree.left[node], mask & left) + check(tree.left[node] + 1, mask & ~left)
        g, h = (0.5 - y[mask]).sum(), 0.25 * mask.sum()
        assert tree.value[node] == pytest.approx(-0.3 * g / (h + 1))
        return 1

    assert check(0, np.ones(300, bool)) >= 3


def test_boosters_and_objectives(spark, sf_dir, rows):
    pair = rows.where("label < 2")
    ones = []
    for options in ({"tree_method": "exact"}, {"scale_pos_weight": 3.0}, {"booster": "dart", "drop_rate": 0.5, "skip_drop": 0.2}):
        model = BoostedModel(2)
        model.fit(pair, objective="binary:logistic", iterations=4, max_depth=3, **options)
        assert accuracy(model, pair) > 0.7
        ones.append(model.predict(pair).where("pred = 1").count())
    assert ones[1] > ones[0]
    linear = BoostedModel(2)
    linear.fit(pair, objective="binary:logistic", booster="gblinear", iterations=5, eta=0.5)
    assert accuracy(linear, pair) > 0.7
    again = BoostedModel(2, repository=linear.repository)
    assert again.predict(pair).select("scores").exceptAll(linear.predict(pair).select("scores")).count() == 0
    for objective in ("reg:linear", "reg:logistic"):
        model = BoostedModel()
        log = model.fit(pair, [pair], objective=objective, iterations=5, max_depth=3, test_interval=5)
        assert log.where("metric = 'loss'").head().value < 0.1
        assert model.predict(pair).schema["pred"].dataType.simpleString() == "double"
    with pytest.raises(ValueError):
        BoostedModel().fit(pair, booster="forest")
    with pytest.raises(ValueError):
        BoostedModel().fit(pair, grow_policy="lossguide")


def test_sparse_rows_boost_like_dense(rows):
    models = []
    for df in (rows, dense_to_sparse(rows)):
        model = BoostedModel(10)
        model.fit(df, iterations=1, max_depth=2)
        models.append([t.feature for t in model.model.rounds[0]])
    assert models[0] == models[1]


def test_weights_as_a_table_equal_broadcast_weights(rows):
    sparse = dense_to_sparse(rows.withColumn("features", F.transform("features", lambda v: F.when(F.abs(v) < 0.3, 0.0).otherwise(v))))
    solver = SolverConfig(iterations=3, base_lr=1.0, momentum=0.9, weight_decay=0.05, lr_policy="step", gamma=0.5, stepsize=2)
    balance = [1.0 + 0.1 * i for i in range(10)]
    small = SoftmaxRegression(10)
    small.fit(sparse, solver=solver, batch_size=None, class_weights=balance)
    wide = WideSoftmaxRegression(10).fit(sparse, solver, balance)
    for r in wide.weights.collect():
        assert r.w == pytest.approx(small.model.weights["w0"][r.feature].tolist(), abs=1e-12)
    assert wide.bias == pytest.approx(small.model.weights["b0"].tolist(), abs=1e-12)
    a, b = ({r.row_id: r.scores for r in m.predict_proba(sparse).collect()} for m in (small, wide))
    assert len(a) == len(b) == rows.count() and all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_models_beyond_the_broadcast_bound_are_refused(rows, monkeypatch):
    monkeypatch.setattr(kernels, "BROADCAST_BYTES", 1000)
    with pytest.raises(ValueError, match="may be broadcast"):
        SoftmaxRegression(10).fit(rows, solver=SolverConfig(iterations=1))


def test_draws_depend_on_row_only():
    ids = np.arange(1000)
    draws = uniform_draws(1, 2, ids, 5)
    assert 0.48 < draws.mean() < 0.52 and draws.min() >= 0 and draws.max() < 1
    assert (uniform_draws(1, 2, ids[::-1], 5)[::-1] == draws).all()
    assert abs(np.corrcoef(draws.T)[0, 1]) < 0.1 and (uniform_draws(1, 3, ids, 5) != draws).any()


def test_linear_booster_converges_on_equal_columns(spark):
    """Twelve equal columns: every round lowers the loss, and sparse rows and several blocks give the same model."""
    x = F.col("id") % 7 / 7.0
    rows = spark.range(400).select((3.0 * x - 1.0).alias("label"), F.array(*[x] * 12).alias("features"))
    losses = []
    for rounds in (1, 2, 5, 10):
        model = BoostedModel()
        model.fit(rows, objective="reg:linear", booster="gblinear", iterations=rounds, base_score=0.0)
        losses.append(model.predict(rows).agg(F.avg((F.col("pred") - F.col("label")) ** 2)).head()[0])
    assert all(b < a for a, b in zip(losses, losses[1:])) and losses[-1] < 0.1


def test_linear_blocks_equal_one_block(spark, monkeypatch):
    from gradloom.plans import linear_boosting

    rows = spark.range(300).select(
        (F.col("id") % 2).cast("int").alias("label"), F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(7)]).alias("features")
    )
    fitted = []
    for width, table in ((512, rows), (3, rows), (3, dense_to_sparse(rows))):
        monkeypatch.setattr(linear_boosting, "BLOCK_FEATURES", width)
        model = BoostedModel()
        model.fit(table, objective="binary:logistic", booster="gblinear", iterations=3)
        fitted.append(model.model.weights)
    assert fitted[1] == pytest.approx(fitted[0], abs=1e-10) and fitted[2] == pytest.approx(fitted[0], abs=1e-10)


def test_a_refit_in_a_used_folder_is_what_reloads(rows):
    model = SoftmaxRegression(10)
    model.fit(rows, solver=SolverConfig(iterations=3, base_lr=1.0), batch_size=None)
    again = SoftmaxRegression(10, repository=model.repository)
    log = again.fit(rows, solver=SolverConfig(iterations=1, base_lr=0.1), batch_size=None)
    assert log.count() == 1
    loaded = SoftmaxRegression(10, repository=model.repository)
    loaded.predict(rows)
    assert loaded.model.weights["w0"] == pytest.approx(again.model.weights["w0"], abs=0)
    trees = BoostedModel(10, repository=model.repository + "-trees")
    trees.fit(rows, iterations=3, max_depth=2)
    fewer = BoostedModel(10, repository=trees.repository)
    log = fewer.fit(rows, iterations=1, max_depth=1)
    assert [(r.iteration, r.metric) for r in log.collect()] == [(1.0, "train_loss")]
    loaded = BoostedModel(10, repository=trees.repository)
    assert loaded.predict(rows).exceptAll(fewer.predict(rows)).count() == 0
    started = BoostedModel(10, weights=RunFolder(rows.sparkSession, trees.repository).snapshot_path(3, "run_1"))
    started.fit(rows, iterations=1, max_depth=1)
    assert started.predict(rows).exceptAll(fewer.predict(rows)).count() > 0


def test_snapshots_carry_their_prefix(rows):
    model = SoftmaxRegression(10)
    model.fit(rows, solver=SolverConfig(2, 1, "night-"), batch_size=None)
    folder = RunFolder(rows.sparkSession, model.repository)
    assert folder.snapshot_path(2, "run_1").endswith("/run_1/night-iter_000000002")
    loaded = SoftmaxRegression(10, repository=model.repository)
    loaded.predict(rows)
    assert loaded.model.weights["w0"] == pytest.approx(model.model.weights["w0"], abs=0)


@pytest.mark.parametrize("kind", ["dense", "svmlight"])
def test_perceptron_with_default_batches_learns(spark, rows, tmp_path, kind):
    """The usual settings: batches of 128 rows, dropout of one half, 500 steps with momentum."""
    train = rows
    if kind == "svmlight":
        write_svmlight(dense_to_sparse(rows), str(tmp_path / "x.svm"))
        train = read_svmlight(spark, str(tmp_path / "x.svm"))
    model = NeuralNetwork(10, layers=[50])
    solver = SolverConfig(iterations=500, base_lr=0.1, gamma=0.1, stepsize=50, momentum=0.9)
    model.fit(train, solver=solver)
    assert accuracy(model, train) > 0.7


def test_labels_outside_the_classes_raise(spark, rows):
    odd = rows.withColumn("label", F.when(F.col("label") == 3, -1).otherwise(F.col("label")))
    with pytest.raises(Exception, match="whole numbers from 0 to 9"):
        SoftmaxRegression(10).fit(odd, solver=SolverConfig(iterations=1), batch_size=None)
    with pytest.raises(Exception, match="whole numbers from 0 to 9"):
        BoostedModel(10).fit(odd, iterations=1, max_depth=1)
    ragged = spark.createDataFrame([([1.0, 2.0],), ([1.0],), ([1.0, 2.0, 3.0],)], "features array<double>").withColumn("label", F.lit(0))
    with pytest.raises(Exception, match="must all hold"):
        SoftmaxRegression(2).fit(ragged, solver=SolverConfig(iterations=1), batch_size=None)
