"""A first layer that is a table against the same network with broadcast weights."""

import numpy as np
import pytest

from gradloom.functions.vectors import dense_to_sparse
from gradloom.plans.network import NetworkModel
from gradloom.plans.repository import RunFolder
from gradloom.plans.solver import RULES, SolverConfig
from gradloom.plans.training import NeuralNetwork, SoftmaxRegression
from gradloom.plans.wide_network import WideNetwork
from gradloom.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = np.where(rng.random((200, 12)) < 0.4, 0.0, rng.normal(size=(200, 12)))
    y = (x[:, :3] @ rng.normal(size=(3, 3))).argmax(axis=1)
    held = [(i, [float(v) for v in r], int(k), [float(r[0] - r[1]), float(r[2])]) for i, (r, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(held, "row_id bigint, features array<double>, label int, targets array<double>").persist()


def table_of(wide, width=12):
    out = np.zeros((width, wide.hidden))
    for r in wide.table.select("feature", "w").collect():
        out[r["feature"]] = r["w"]
    return out


@pytest.mark.parametrize("rule", RULES)
def test_every_rule_with_minibatches(rows, rule):
    momentum = 0.9 if rule in ("SGD", "NESTEROV") else None
    solver = SolverConfig(iterations=4, base_lr=0.1, solver_type=rule, momentum=momentum, weight_decay=0.01)
    plain = SoftmaxRegression(3)
    plain.fit(rows.drop("targets"), solver=solver, batch_size=60, class_weights=[1.0, 2.0, 0.5])
    wide = WideNetwork(3).fit(dense_to_sparse(rows.drop("targets")), solver, batch_size=60, class_weights=[1.0, 2.0, 0.5])
    assert table_of(wide) == pytest.approx(plain.model.weights["w0"], abs=1e-9)
    assert wide.model.weights["b0"] == pytest.approx(plain.model.weights["b0"], abs=1e-9)


def test_perceptron_with_dropout(spark, rows):
    start = NetworkModel.initial(12, 3, (6, 4), seed=5)
    folder = RunFolder(spark, scratch_path(spark, "start"))
    folder.save_snapshot(0, {**start.weights, "state.step": np.array([0.0])})
    solver = SolverConfig(iterations=3, base_lr=0.2, momentum=0.5)
    plain = NeuralNetwork(3, layers=(6, 4), dropout=0.5, weights=folder.snapshot_path(0))
    log = plain.fit(rows.drop("targets"), solver=solver, batch_size=None)
    wide = WideNetwork(3, layers=(6, 4), dropout=0.5).fit(rows, solver, start=start)
    assert table_of(wide) == pytest.approx(plain.model.weights["w0"], abs=1e-9)
    for name in ("b0", "w1", "b1", "w2", "b2"):
        assert wide.model.weights[name] == pytest.approx(plain.model.weights[name], abs=1e-9)
    assert wide.losses == pytest.approx([r.value for r in log.where("metric = 'train_loss'").orderBy("iteration").collect()])
    a, b = ({r.row_id: r.scores for r in m.predict(rows).collect()} for m in (plain, wide))
    assert all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a) and len(a) == len(b) == 200


def test_regression_and_rows_without_entries(spark, rows):
    solver = SolverConfig(iterations=2, base_lr=0.1)
    plain = SoftmaxRegression(ntargets=2, regression=True)
    plain.fit(rows, solver=solver, batch_size=None)
    wide = WideNetwork(2, regression=True).fit(rows, solver)
    assert table_of(wide) == pytest.approx(plain.model.weights["w0"], abs=1e-9)
    empty = spark.createDataFrame([(7, [], [])], "row_id bigint, indices array<int>, values array<double>")
    assert wide.predict_proba(empty).head().scores == pytest.approx(wide.model.weights["b0"].tolist())


def test_drawn_first_weights_learn(rows):
    wide = WideNetwork(3, layers=(8,), seed=1).fit(rows, SolverConfig(iterations=12, base_lr=0.3, solver_type="ADAM"))
    assert wide.losses[-1] < 0.8 * wide.losses[0]


@pytest.mark.parametrize("rule", ["ADAM", "NESTEROV"])
def test_snapshots_log_and_resume(spark, rows, rule):
    """Two fits, the second from the snapshot of the first, equal one; the log is that of broadcast weights."""
    data = rows.drop("targets")
    settings = {"base_lr": 0.1, "solver_type": rule, "test_interval": 2, "momentum": 0.9 if rule == "NESTEROV" else None}
    checks = [data.where("row_id < 70"), data.where("row_id >= 50")]
    place = scratch_path(spark, "wide")
    WideNetwork(3, layers=(5,), repository=place, seed=2).fit(data.where("row_id >= 0"), SolverConfig(iterations=3, snapshot=2, **settings), 60)
    assert RunFolder(spark, place).snapshots().select("iteration").distinct().count() == 2
    tables = spark.read.option("recursiveFileLookup", True).parquet(f"{place}/first_layer").select("_metadata.file_path").distinct().collect()
    assert {r.file_path.split("/")[-2] for r in tables} == {f"iter_{i:09d}" for i in (0, 2, 3)}
    resumed = WideNetwork(3, layers=(5,), repository=place, seed=2, resume=True).fit(data, SolverConfig(iterations=2, **settings), 60)
    whole = WideNetwork(3, layers=(5,), seed=2).fit(data, SolverConfig(iterations=5, **settings), 60, validation_data=checks)
    assert table_of(resumed) == pytest.approx(table_of(whole), abs=1e-12) and resumed.state.step == 5
    for name in ("b0", "w1", "b1"):
        assert resumed.model.weights[name] == pytest.approx(whole.model.weights[name], abs=1e-12)
    assert resumed.log().where("metric = 'train_loss'").count() == 5
    loaded = WideNetwork(3, layers=(5,), repository=place)
    a, b = ({r.row_id: r.scores for r in m.predict(data).collect()} for m in (loaded, whole))
    assert all(a[i] == pytest.approx(b[i], abs=1e-9) for i in b) and len(a) == 200

    plain = SoftmaxRegression(3)
    solver = SolverConfig(iterations=4, test_initialization=True, **settings)
    want = plain.fit(data, checks, solver, batch_size=None).drop("log").collect()
    got = WideNetwork(3).fit(data, solver, validation_data=checks).log().drop("log").collect()
    key = lambda r: (r.iteration, r.split, r.metric)
    assert sorted(map(key, got)) == sorted(map(key, want))
    values = {key(r): r.value for r in want}
    assert all(values[key(r)] == pytest.approx(r.value, abs=1e-9) for r in got)


def test_features_new_to_a_resumed_run(spark):
    rows = spark.createDataFrame([(i, [i % 3], [1.0], i % 2) for i in range(30)], "row_id bigint, indices array<int>, values array<double>, label int")
    more = spark.createDataFrame([(i, [7], [1.0], 1) for i in range(9)], rows.schema)
    place = scratch_path(spark, "wide")
    first = WideNetwork(2, repository=place).fit(rows, SolverConfig(iterations=2, base_lr=0.5))
    before = {r.feature: r.w for r in first.table.collect()}
    wide = WideNetwork(2, repository=place, resume=True).fit(more, SolverConfig(iterations=1, base_lr=0.5))
    after = {r.feature: r.w for r in wide.table.collect()}
    assert set(after) == {0, 1, 2, 7} and all(after[f] == before[f] for f in before) and after[7][1] > 0 > after[7][0]
