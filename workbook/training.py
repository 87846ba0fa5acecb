"""Queries over training: gradient iterations, solvers, snapshots and boosting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.functions.hashing import draw
from gradloom.functions.schedules import rate_column
from gradloom.functions.vectors import dense_to_sparse
from gradloom.plans.booster import BoostedModel
from gradloom.plans.cells import weighted_edges
from gradloom.plans.network import NetworkModel, network_gradient
from gradloom.plans.repository import RunFolder
from gradloom.plans.solver import RULES, SolverConfig
from gradloom.plans.training import NeuralNetwork, SoftmaxRegression
from gradloom.plans.wide_network import WideNetwork
from gradloom.session import local_table, scratch_path
from gradloom.sources.svmlight import read_svmlight, write_svmlight
from workbook.inputs import (
    NCLASSES,
    WIDTH,
    X_SQL,
    dealt_table,
    predictions,
    probabilities,
    softmax_chain,
    split_vectors,
    table,
    training_rows,
)

R6 = lambda c: F.round(c, 6) + F.lit(0.0)  # noqa: E731 - the sum turns -0.0 into 0.0
MLP_STEPS = 4
CLASS_WEIGHTS = [0.5 + 0.25 * k for k in range(NCLASSES)]


def weight_rows(spark: SparkSession, weights: dict[str, np.ndarray], **tags) -> DataFrame:
    """Weights and bias of a layerless model as (f, k, w) rows; the bias is feature 64."""
    stacked = np.vstack([weights["w0"], weights["b0"]])
    rows = [(f, k, float(stacked[f, k])) for f in range(stacked.shape[0]) for k in range(stacked.shape[1])]
    tagged = local_table(spark, rows, "f int, k int, w double").withColumn("w", R6("w"))
    return tagged.select(*[F.lit(v).alias(n) for n, v in tags.items()], "f", "k", "w")


def _fit(spark, sf_dir, solver: SolverConfig, **options) -> SoftmaxRegression:
    model = SoftmaxRegression(NCLASSES)
    model.fit(training_rows(spark, sf_dir), solver=solver, batch_size=None, **options)
    return model


def c01_softmax_gradient(spark, sf_dir):
    zero = NetworkModel.initial(WIDTH, NCLASSES)
    _, _, gradients = network_gradient(training_rows(spark, sf_dir), zero, 1)
    return weight_rows(spark, gradients)


def c02_fit_softmax(spark, sf_dir):
    solver = SolverConfig(
        iterations=3, base_lr=1.0, lr_policy="step", gamma=0.5, stepsize=2, momentum=0.9, weight_decay=0.01
    )
    return weight_rows(spark, _fit(spark, sf_dir, solver, class_weights=CLASS_WEIGHTS).model.weights)


def c03_fit_mlp(spark, sf_dir):
    """Four steps with momentum of a network with six hidden units from given weights."""
    model = NetworkModel.initial(WIDTH, NCLASSES, (6,), "relu")
    i, j = np.indices((WIDTH, 6))
    model.weights["w0"] = ((7 * i + 11 * j + 3) % 17 - 8) / 40.0
    i, j = np.indices((6, NCLASSES))
    model.weights["w1"] = ((5 * i + 3 * j + 1) % 13 - 6) / 20.0
    folder = RunFolder(spark, scratch_path(spark, "start"))
    folder.save_snapshot(0, {**model.weights, "state.step": np.array([0.0])})
    network = NeuralNetwork(NCLASSES, layers=(6,), dropout=0.0, weights=folder.snapshot_path(0))
    solver = SolverConfig(iterations=MLP_STEPS, base_lr=0.2, momentum=0.9)
    network.fit(training_rows(spark, sf_dir), solver=solver, batch_size=None)
    rows = []
    for layer, names in enumerate((("w0", "b0"), ("w1", "b1"))):
        stacked = np.vstack([network.model.weights[n] for n in names])
        rows += [(layer, f, k, float(stacked[f, k])) for f in range(stacked.shape[0]) for k in range(stacked.shape[1])]
    return local_table(spark, rows, "layer int, f int, k int, w double").withColumn("w", R6("w"))


# -- boosting -------------------------------------------------------------------------------------------------

LINE_ID = "l_orderkey * 10 + l_linenumber"


def _line_features(spark, sf_dir, label, columns, row_id=None):
    used = ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_linestatus", "l_returnflag"]
    rows = dealt_table(spark, sf_dir, "lineitem", *used)
    ids = [] if row_id is None else [F.expr(row_id).alias("row_id")]
    return rows.select(*ids, label.alias("label"), F.array(*[F.col(c).cast("double") for c in columns]).alias("features"))


def _nodes(spark, model, *more):
    nodes = model.model.split_table(spark)
    return nodes.select(
        "round", "output", "node", "feature", R6("threshold").alias("threshold"), F.round("gain", 4).alias("gain"),
        R6("value").alias("value"), R6("scale").alias("scale"), *more,
    )


FOUR = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
CUT_BINS = 16


def _open_label():
    return (F.col("l_linestatus") == "O").cast("int")


# With this seed and a drop rate of one half, round 2 drops the first of two trees and round 3 the second of three.
DART_SEED = 2


def c04_boosted_binary(spark, sf_dir):
    model = BoostedModel()
    rows = _line_features(spark, sf_dir, _open_label(), FOUR)
    model.fit(rows, objective="binary:logistic", iterations=2, max_depth=2)
    return _nodes(spark, model)


def c05_boosted_multiclass(spark, sf_dir):
    code = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    model = BoostedModel(3)
    model.fit(_line_features(spark, sf_dir, code, FOUR), objective="multi:softprob", iterations=2, max_depth=2)
    return _nodes(spark, model)


def c06_boosted_squared(spark, sf_dir):
    model = BoostedModel()
    rows = _line_features(spark, sf_dir, F.col("l_quantity"), FOUR[1:])
    model.fit(rows, objective="reg:linear", base_score=25.0, iterations=2, max_depth=2)
    return _nodes(spark, model)


def c07_boosted_logistic_target(spark, sf_dir):
    model = BoostedModel()
    rows = _line_features(spark, sf_dir, F.col("l_discount") * 10.0, ["l_quantity", "l_tax", "l_linenumber"])
    model.fit(rows, objective="reg:logistic", iterations=2, max_depth=2)
    return _nodes(spark, model)


def c08_dart(spark, sf_dir):
    """Four rounds in which the seed drops a proper subset of the trees before."""
    model = BoostedModel()
    rows = _line_features(spark, sf_dir, _open_label(), FOUR)
    model.fit(rows, objective="binary:logistic", booster="dart", iterations=4, max_depth=1, drop_rate=0.5, seed=DART_SEED)
    return _nodes(spark, model)


def c09_linear_booster(spark, sf_dir):
    model = BoostedModel()
    rows = _line_features(spark, sf_dir, _open_label(), FOUR)
    options = {"lambda": 2.0, "alpha": 0.5, "lambda_bias": 1.0, "eta": 0.5}
    model.fit(rows, objective="binary:logistic", booster="gblinear", iterations=3, **options)
    fitted = model.model
    weights = [(f, float(w)) for f, w in enumerate([*fitted.weights[:, 0], fitted.bias[0]])]
    return local_table(spark, weights, "f int, w double").withColumn("w", R6("w"))


def c10_booster_parameters(spark, sf_dir):
    model = BoostedModel()
    rows = _line_features(spark, sf_dir, _open_label(), FOUR, LINE_ID)
    options = {
        "subsample": 0.7, "colsample": 0.5, "seed": 4,
        "lambda": 2.0, "alpha": 1.0, "gamma": 0.01, "min_child_weight": 100, "max_delta_step": 0.005, "eta": 0.1,
        "scale_pos_weight": 1.02,
    }
    model.fit(rows, objective="binary:logistic", iterations=2, max_depth=2, **options)
    return _nodes(spark, model)


# -- solver, snapshots, log -----------------------------------------------------------------------------------

def c11_solver_rules(spark, sf_dir):
    """Weights after two steps of every update rule."""
    parts = []
    for rule in RULES:
        momentum = 0.9 if rule in ("SGD", "NESTEROV") else None
        solver = SolverConfig(iterations=2, base_lr=0.1, solver_type=rule, momentum=momentum)
        parts.append(weight_rows(spark, _fit(spark, sf_dir, solver).model.weights, rule=rule))
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return everything


def c12_lr_schedule(spark, sf_dir):
    """The rate of every policy at the iteration each event names."""
    t = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").select("event_id", t.alias("t"))
    return events.select(
        "event_id",
        R6(rate_column("fixed", F.col("t"), 0.1)).alias("fixed"),
        R6(rate_column("step", F.col("t"), 0.1, gamma=0.5, stepsize=20)).alias("step"),
        R6(rate_column("inv", F.col("t"), 0.1, gamma=0.05, power=0.75)).alias("inv"),
    )


def c13_weight_decay(spark, sf_dir):
    solver = SolverConfig(iterations=2, base_lr=1.0, weight_decay=0.1)
    return weight_rows(spark, _fit(spark, sf_dir, solver).model.weights)


def c14_periodic_evaluation(spark, sf_dir):
    rows = split_vectors(spark, sf_dir)
    train, test = (rows.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    solver = SolverConfig(iterations=2, base_lr=1.0, test_interval=1)
    log = SoftmaxRegression(NCLASSES).fit(train, [test, train], solver, None, metrics=("mcll", "acc"))
    return log.select("iteration", "split", "metric", R6("value").alias("value"))


def c15_snapshots(spark, sf_dir):
    model = _fit(spark, sf_dir, SolverConfig(iterations=2, base_lr=1.0, snapshot=1))
    stored = RunFolder(spark, model.repository).snapshots().where(F.col("name").isin("w0", "b0"))
    cells = stored.select("iteration", "name", F.posexplode("values").alias("at", "w"))
    return cells.select(
        "iteration",
        F.when(F.col("name") == "b0", WIDTH).otherwise(F.floor(F.col("at") / NCLASSES)).cast("int").alias("f"),
        (F.col("at") % NCLASSES).alias("k"),
        R6("w").alias("w"),
    )


def c16_resume(spark, sf_dir):
    """One step, then two more by a new estimator on the same folder: the same as three in a row."""
    first = _fit(spark, sf_dir, SolverConfig(iterations=1, base_lr=1.0, momentum=0.9))
    second = SoftmaxRegression(NCLASSES, repository=first.repository, resume=True)
    solver = SolverConfig(iterations=2, base_lr=1.0, momentum=0.9)
    second.fit(training_rows(spark, sf_dir), solver=solver, batch_size=None)
    return weight_rows(spark, second.model.weights)


def c17_start_from_snapshot(spark, sf_dir):
    """Predictions of the first of two snapshots, read by name."""
    model = _fit(spark, sf_dir, SolverConfig(iterations=2, base_lr=1.0, snapshot=1))
    weights = RunFolder(spark, model.repository).snapshot_path(1, "run_1")
    chosen = SoftmaxRegression(NCLASSES, repository=model.repository, weights=weights)
    return chosen.predict(split_vectors(spark, sf_dir)).select("row_id", "pred")


def c18_refit(spark, sf_dir):
    """A second fit in the same folder starts from scratch and logs under its own run."""
    model = SoftmaxRegression(NCLASSES, name="again")
    rows, solver = training_rows(spark, sf_dir), SolverConfig(iterations=2, base_lr=1.0)
    model.fit(rows, solver=solver, batch_size=None)
    model.fit(rows, solver=solver, batch_size=None)
    log = RunFolder(spark, model.repository).log()
    return log.select("log", "iteration", R6("value").alias("train_loss"))


def c19_regression(spark, sf_dir):
    rows = dealt_table(spark, sf_dir, "lineitem", "l_quantity", "l_discount", "l_tax", "l_extendedprice").select(
        F.array(F.col("l_quantity") / 50.0, F.col("l_discount"), F.col("l_tax")).alias("features"),
        F.array(F.col("l_extendedprice") / 100000.0).alias("targets"),
    )
    model = SoftmaxRegression(ntargets=1, regression=True)
    model.fit(rows, solver=SolverConfig(iterations=2, base_lr=0.5), batch_size=None)
    return weight_rows(spark, model.model.weights)


def c20_training_log(spark, sf_dir):
    solver = SolverConfig(iterations=3, base_lr=1.0)
    log = SoftmaxRegression(NCLASSES).fit(
        training_rows(spark, sf_dir), solver=solver, batch_size=None, display_metric_interval=2
    )
    return log.select("iteration", "metric", R6("value").alias("value"))


def c21_minibatches(spark, sf_dir):
    """Ten steps of 128 rows each, several times around the training rows."""
    model = SoftmaxRegression(NCLASSES)
    model.fit(training_rows(spark, sf_dir), solver=SolverConfig(iterations=10, base_lr=0.5, momentum=0.5), batch_size=128)
    return weight_rows(spark, model.model.weights)


def c22_exact_cuts(spark, sf_dir):
    """Trees on a column of nearly as many values as rows, each of them tried as a cut."""
    rows = dealt_table(spark, sf_dir, "lineitem", "l_extendedprice", "l_quantity", "l_linestatus").select(
        _open_label().alias("label"), F.array("l_extendedprice", F.col("l_quantity").cast("double")).alias("features")
    )
    model = BoostedModel()
    model.fit(rows, objective="binary:logistic", iterations=2, max_depth=2, tree_method="exact", test_interval=0)
    return _nodes(spark, model)


def c23_weighted_cuts(spark, sf_dir):
    """Cuts at even steps of a weight, as ``tree_method="approx"`` proposes them from second derivatives."""
    rows = dealt_table(spark, sf_dir, "lineitem", *FOUR, "l_extendedprice").select(
        F.array(*[F.col(c).cast("double") for c in FOUR]).alias("features"), F.col("l_extendedprice").cast("double").alias("w")
    )
    edges = weighted_edges(rows, len(FOUR), CUT_BINS, weight="w")
    cuts = [(f, float(v)) for f, held in enumerate(edges) for v in held]
    return local_table(spark, cuts, "f int, cut double")


def c24_boosted_sparse(spark, sf_dir):
    """Trees on svmlight rows whose absent entries are missing and go to the better side."""
    rows = dense_to_sparse(_line_features(spark, sf_dir, _open_label(), FOUR))
    path = scratch_path(spark, "sparse")
    write_svmlight(rows, path)
    model = BoostedModel()
    model.fit(
        read_svmlight(spark, path), objective="binary:logistic", iterations=2, max_depth=2, absent="missing",
        num_feature=len(FOUR), test_interval=0,
    )
    return _nodes(spark, model, "missing_left")


def c25_table_of_weights(spark, sf_dir):
    """Minibatches with momentum as ``c21_minibatches``, the weights a table that is never collected."""
    model = WideNetwork(NCLASSES)
    model.fit(training_rows(spark, sf_dir), SolverConfig(iterations=4, base_lr=0.5, momentum=0.5), batch_size=128)
    cells = model.table.select(F.col("feature").alias("f"), F.posexplode("w").alias("k", "w"))
    bias = [(WIDTH, k, float(w)) for k, w in enumerate(model.model.weights["b0"])]
    return cells.unionByName(local_table(spark, bias, "f int, k int, w double")).select("f", "k", R6("w").alias("w"))


QUERIES = [
    c01_softmax_gradient, c02_fit_softmax, c03_fit_mlp, c04_boosted_binary, c05_boosted_multiclass,
    c06_boosted_squared, c07_boosted_logistic_target, c08_dart, c09_linear_booster, c10_booster_parameters,
    c11_solver_rules, c12_lr_schedule, c13_weight_decay, c14_periodic_evaluation, c15_snapshots, c16_resume,
    c17_start_from_snapshot, c18_refit, c19_regression, c20_training_log, c21_minibatches, c22_exact_cuts,
    c23_weighted_cuts, c24_boosted_sparse, c25_table_of_weights,
]


# -- SQL ------------------------------------------------------------------------------------------------------

def _weights_sql(name: str) -> str:
    return f"SELECT f::INT AS f, k::INT AS k, round(w, 6) + 0.0 AS w FROM {name}"


def _trees_sql(label: str, columns: list[str], objective: str, rounds: int, depth: int, outputs: int = 1, base: float = 0.0,
               eta: float = 0.3, lam: float = 1.0, alpha: float = 0.0, gamma: float = 0.0, child: float = 1.0,
               step: float = 0.0, weight: str = "1.0::DOUBLE", subsample: float = 1.0, colsample: float = 1.0,
               drop: float | None = None, seed: int = 0, missing: bool = False) -> str:
    """Boosting round by round and level by level; every distinct value is tried as a cut.

    With ``missing``, null values are tried on either side of each cut.
    """
    def shrink(g):
        return f"sign({g}) * greatest(abs({g}) - {alpha}, 0)"

    def part(g, h):
        return f"pow({shrink(g)}, 2) / ({h} + {lam})"

    def leaf(g, h):
        value = f"-({shrink(g)}) / ({h} + {lam})"
        if step:
            value = f"greatest(least({value}, {step}), -{step})"
        return f"{eta} * ({value})"

    names = ", ".join(f"({c})::DOUBLE AS x{i}" for i, c in enumerate(columns))
    listed = ", ".join(f"x{i}" for i in range(len(columns)))
    derived = {
        "multi:softprob": "p - (y = o)::INT AS g, greatest(2 * p * (1 - p), 1e-16) AS h FROM (SELECT *, exp(m) / sum(exp(m)) OVER (PARTITION BY id) AS p FROM {m})",
        "reg:linear": "m - y AS g, 1::DOUBLE AS h FROM {m}",
    }.get(objective, "p - y AS g, greatest(p * (1 - p), 1e-16) AS h FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM {m})")
    parts = [
        f"r AS MATERIALIZED (SELECT row_number() OVER () AS id, l_orderkey * 10 + l_linenumber AS row_id, ({label})::DOUBLE AS y, {weight} AS w, {names} FROM lineitem)",
        f"x AS MATERIALIZED (SELECT id, unnest(range({len(columns)})) AS f, unnest([{listed}]) AS v FROM r)",
    ]
    scales: list[float] = []

    def cumulated(k):
        """Sums left of every cut and of the whole node; with ``missing`` each cut twice, the missing rows right (side 0) or left."""
        right = (
            f"SELECT o, node, f, v, 0 AS side, sum(g) OVER a AS gl, sum(h) OVER a AS hl, sum(g) OVER b AS gt, sum(h) OVER b AS ht FROM v{k} "
            "WINDOW a AS (PARTITION BY o, node, f ORDER BY v NULLS LAST), b AS (PARTITION BY o, node, f)"
        )
        if not missing:
            return right
        holes = f"(SELECT o, node, f, g AS gm, h AS hm FROM v{k} WHERE v IS NULL)"
        return (
            f"WITH r AS ({right}) SELECT * FROM r WHERE v IS NOT NULL UNION ALL "
            f"SELECT o, node, f, v, 1, gl + gm, hl + hm, gt, ht FROM r JOIN {holes} USING (o, node, f) WHERE v IS NOT NULL"
        )

    def margins(factors):
        terms = "".join(f" + {f!r}::DOUBLE * coalesce(t{i}.value, 0)" for i, f in enumerate(factors) if f)
        joins = "".join(f" JOIN leaf{i} t{i} USING (id, o)" for i, f in enumerate(factors) if f)
        return f"(SELECT id, row_id, y, w, o, {base!r}::DOUBLE{terms} AS m FROM (SELECT * FROM r, range({outputs}) q(o)){joins})"

    for n in range(rounds):
        dropped = []
        if drop is not None and draw(seed, n, "skip") >= 0.0:
            dropped = [i for i in range(n) if draw(seed, n, "drop", i) < drop]
        drawn = f"WHERE ('0x' || substr(md5('{seed}:{n}:' || row_id), 1, 8))::BIGINT / 4294967296.0 < {subsample}" if subsample < 1 else ""
        parts.append(f"m{n} AS MATERIALIZED {margins([0.0 if i in dropped else s for i, s in enumerate(scales)])}")
        parts.append(f"g{n} AS MATERIALIZED (SELECT id, o, w * g AS g, w * h AS h FROM (SELECT id, row_id, o, w, {derived.format(m=f'm{n}')}) {drawn})")
        parts.append(f"n{n}_0 AS MATERIALIZED (SELECT id, o, 0 AS node, 0 AS born FROM r, range({outputs}) q(o))")
        allowed = []
        for o in range(outputs):
            order = sorted(range(len(columns)), key=lambda j: (draw(seed, n, o, j), j))
            allowed += [f"({o}, {j})" for j in order[: max(1, round(colsample * len(columns)))]]
        open_ = f"(o, f) IN ({', '.join(allowed)})" if colsample < 1 else "true"
        for level in range(depth):
            k = f"{n}_{level}"
            parts.append(
                f"v{k} AS (SELECT o, node, f, v + 0.0 AS v, sum(g) AS g, sum(h) AS h FROM n{k} JOIN g{n} USING (id, o) JOIN x USING (id) "
                f"WHERE born = {level} GROUP BY ALL), "
                f"c{k} AS ({cumulated(k)}), "
                f"q{k} AS (SELECT *, 0.5 * ({part('gl', 'hl')} + {part('(gt - gl)', '(ht - hl)')} - {part('gt', 'ht')}) - {gamma} AS gain "
                f"FROM c{k} WHERE hl >= {child} AND ht - hl >= {child} AND {open_}), "
                f"s{k} AS MATERIALIZED (SELECT *, {1 if level == 0 else 3} + 2 * (row_number() OVER (PARTITION BY o ORDER BY node) - 1) AS kid FROM ("
                f"SELECT * FROM q{k} WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY o, node ORDER BY round(gain, 9) DESC, f, side, v) = 1)), "
                f"n{n}_{level + 1} AS MATERIALIZED (SELECT n.id, n.o, CASE WHEN s.kid IS NULL OR n.born < {level} THEN n.node ELSE s.kid + coalesce(x.v > s.v, s.side = 0)::INT END AS node, "
                f"CASE WHEN s.kid IS NULL OR n.born < {level} THEN n.born ELSE {level + 1} END AS born "
                f"FROM n{k} n LEFT JOIN s{k} s ON n.o = s.o AND n.node = s.node LEFT JOIN x ON x.id = n.id AND x.f = s.f)"
            )
        values = [f"SELECT DISTINCT o, 0 AS node, {leaf('gt', 'ht')} AS value FROM c{n}_0 WHERE node = 0"]
        for level in range(depth):
            values.append(f"SELECT o, kid, {leaf('gl', 'hl')} FROM s{n}_{level}")
            values.append(f"SELECT o, kid + 1, {leaf('(gt - gl)', '(ht - hl)')} FROM s{n}_{level}")
        splits = " UNION ALL ".join(f"SELECT o, node, f, v, gain, side FROM s{n}_{level}" for level in range(depth))
        parts.append(f"val{n} AS MATERIALIZED (SELECT o, node, any_value(value) AS value FROM ({' UNION ALL '.join(values)}) GROUP BY o, node)")
        parts.append(f"spl{n} AS ({splits})")
        parts.append(f"leaf{n} AS MATERIALIZED (SELECT id, o, value FROM n{n}_{depth} JOIN val{n} USING (o, node))")
        if dropped:
            scales = [s * len(dropped) / (len(dropped) + eta) if i in dropped else s for i, s in enumerate(scales)]
        scales.append(1.0 / (len(dropped) + eta) if dropped else 1.0)
    rows = [
        f"SELECT {n} AS round, o::INT AS output, node::INT AS node, coalesce(f, -1)::INT AS feature, coalesce(round(v, 6), 0)::DOUBLE AS threshold, "
        f"coalesce(round(gain, 4), 0)::DOUBLE AS gain, round(value, 6) + 0.0 AS value, round({scales[n]!r}::DOUBLE, 6) AS scale{', coalesce(side, 0) = 1 AS missing_left' if missing else ''} "
        f"FROM val{n} LEFT JOIN spl{n} USING (o, node)"
        for n in range(rounds)
    ]
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(rows)


_Y = "(l_linestatus = 'O')::INT"
_CODE = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"
_LINEAR_COLUMNS = ["l_quantity / 50", "l_discount", "l_tax", "1"]


def _delta(g: str, h: str, w: str = "0", l1: float = 0.5, l2: float = 2.0) -> str:
    """Soft-thresholded coordinate change of w that never crosses zero."""
    return (
        f"CASE WHEN {h} < 1e-5 THEN 0 WHEN {w} - ({g} + {l2} * {w}) / ({h} + {l2}) >= 0 "
        f"THEN greatest(-({g} + {l2} * {w} + {l1}) / ({h} + {l2}), -{w}) "
        f"ELSE least(-({g} + {l2} * {w} - {l1}) / ({h} + {l2}), -{w}) END"
    )


def _linear_sql(columns: list[str], rounds: int, eta: float = 0.5) -> str:
    """Rounds of cyclic coordinate descent from zero: one row of weights per round, one row of sums per pass."""
    n = len(columns)
    names = ", ".join(f"{c}::DOUBLE AS x{i}" for i, c in enumerate(columns))
    parts = [
        f"x AS (SELECT {_Y}::DOUBLE AS y, {names} FROM lineitem)",
        "w0 AS (SELECT 0::DOUBLE AS b, " + ", ".join(f"0::DOUBLE AS w{i}" for i in range(n)) + ")",
    ]
    margin = "b + " + " + ".join(f"w{i} * x{i}" for i in range(n))
    for r in range(rounds):
        sums = ["sum(p - y) AS g, sum(p * (1 - p)) AS h"]
        sums += [f"sum((p - y) * x{i}) AS g{i}, sum(p * (1 - p) * x{i}) AS h{i}" for i in range(n)]
        sums += [f"sum(p * (1 - p) * x{i} * x{j}) AS q{i}{j}" for i in range(n) for j in range(i + 1)]
        parts.append(f"s{r} AS (SELECT {', '.join(sums)} FROM (SELECT x.*, 1 / (1 + exp(-({margin}))) AS p FROM x, w{r}))")
        parts.append(f"c{r} AS (SELECT *, {eta} * -(g + b) / (h + 1) AS d FROM s{r}, w{r})")
        before = f"c{r}"
        for i in range(n):
            seen = "".join(f" + q{i}{j} * d{j}" for j in range(i))
            parts.append(
                f"e{r}_{i} AS (SELECT *, {eta} * ({_delta(f'r{i}', f'q{i}{i}', f'w{i}')}) AS d{i} "
                f"FROM (SELECT *, g{i} + h{i} * d{seen} AS r{i} FROM {before}))"
            )
            before = f"e{r}_{i}"
        parts.append(f"w{r + 1} AS (SELECT b + d AS b, " + ", ".join(f"w{i} + d{i} AS w{i}" for i in range(n)) + f" FROM {before})")
    rows = [f"SELECT {i} AS f, round(w{i}, 6) + 0.0 AS w FROM w{rounds}" for i in range(n)]
    rows.append(f"SELECT {n}, round(b, 6) + 0.0 FROM w{rounds}")
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(rows)


def _regression_chain(steps: int, rate: float) -> str:
    parts = ["r0 AS (SELECT f, 0::DOUBLE AS w FROM range(4) t(f))"]
    for t in range(steps):
        parts.append(
            f"z{t} AS (SELECT id, any_value(y) AS y, sum(v * w) AS z FROM d JOIN r{t} USING (f) GROUP BY id), "
            f"r{t + 1} AS (SELECT f, any_value(w) - {rate} * sum(v * (z - z{t}.y)) / count(*) AS w "
            f"FROM d JOIN z{t} USING (id) JOIN r{t} USING (f) GROUP BY f)"
        )
    return ", ".join(parts)


def _eval_sql(t: int) -> str:
    return f"""
SELECT {t}::DOUBLE AS iteration, split, 'mcll' AS metric, round(avg(-ln(p)), 6) + 0.0 AS value
FROM e{t} WHERE k = label GROUP BY split
UNION ALL SELECT {t}, split, 'acc', round(avg((label = pred)::INT), 6) FROM d{t} GROUP BY split"""


def _loss_sql(t: int) -> str:
    return f"(SELECT round(avg(-ln(p)), 6) + 0.0 FROM p{t} WHERE k = label)"


def _hidden_sql(steps: int, rate: float, mu: float) -> str:
    """A network of six hidden units, step by step; every weight next to its velocity."""
    parts = [
        """w0_0 AS (SELECT f, j, CASE WHEN f = 64 THEN 0 ELSE ((7 * f + 11 * j + 3) % 17 - 8) / 40.0::DOUBLE END AS w, 0::DOUBLE AS m
       FROM range(65) a(f), range(6) b(j)),
w1_0 AS (SELECT j, k, CASE WHEN j = 6 THEN 0 ELSE ((5 * j + 3 * k + 1) % 13 - 6) / 20.0::DOUBLE END AS w, 0::DOUBLE AS m
       FROM range(7) a(j), range(10) b(k)),
n AS (SELECT count(*) AS n FROM tr WHERE f = 64)"""
    ]
    for t in range(steps):
        parts.append(f"""
h0_{t} AS MATERIALIZED (SELECT row_id, label, j, sum(v * w) AS z FROM tr JOIN w0_{t} USING (f) GROUP BY row_id, label, j),
h_{t} AS (SELECT row_id, label, j, greatest(z, 0) AS a FROM h0_{t}
      UNION ALL SELECT DISTINCT row_id, label, 6, 1::DOUBLE FROM h0_{t}),
p_{t} AS MATERIALIZED (SELECT row_id, k, exp(z) / sum(exp(z)) OVER (PARTITION BY row_id) - (k = label)::INT AS r
      FROM (SELECT row_id, label, k, sum(a * w) AS z FROM h_{t} JOIN w1_{t} USING (j) GROUP BY row_id, label, k)),
g1_{t} AS (SELECT j, k, sum(a * r) AS g FROM h_{t} JOIN p_{t} USING (row_id) GROUP BY j, k),
back_{t} AS (SELECT row_id, j, sum(r * w) AS b FROM p_{t} JOIN w1_{t} USING (k) WHERE j < 6 GROUP BY row_id, j),
g0_{t} AS (SELECT f, j, sum(v * b * (z > 0)::INT) AS g FROM tr JOIN back_{t} USING (row_id) JOIN h0_{t} USING (row_id, j) GROUP BY f, j),
w0_{t + 1} AS MATERIALIZED (SELECT f, j, w - m AS w, m FROM (SELECT f, j, w, {mu} * m + {rate} * g / n AS m FROM w0_{t} JOIN g0_{t} USING (f, j), n)),
w1_{t + 1} AS MATERIALIZED (SELECT j, k, w - m AS w, m FROM (SELECT j, k, w, {mu} * m + {rate} * g / n AS m FROM w1_{t} JOIN g1_{t} USING (j, k), n))""")
    return f"""
WITH {X_SQL}, {", ".join(parts)}
SELECT 0 AS layer, f::INT AS f, j::INT AS k, round(w, 6) + 0.0 AS w FROM w0_{steps}
UNION ALL SELECT 1, j::INT, k::INT, round(w, 6) + 0.0 FROM w1_{steps}"""


def _minibatch_sql(steps: int) -> str:
    return f"""
WITH {X_SQL}, place AS (
  SELECT row_id, (row_number() OVER (ORDER BY md5('0:' || row_id), row_id) - 1) // 128 AS b FROM tr WHERE f = 64),
bt AS MATERIALIZED (SELECT tr.*, b, (SELECT max(b) + 1 FROM place) AS bs FROM tr JOIN place USING (row_id)),
{softmax_chain(steps, [0.5] * steps, mu=0.5, batches="(SELECT * EXCLUDE (b, bs) FROM bt WHERE b = {t} % bs)")} {_weights_sql(f"w{steps}")}"""


SQL = {
    "c01_softmax_gradient": f"""
WITH {X_SQL}, {softmax_chain(1)} SELECT f::INT AS f, k::INT AS k, round(g, 6) + 0.0 AS w FROM g0""",
    "c02_fit_softmax": f"""
WITH {X_SQL}, {softmax_chain(3, [1.0, 1.0, 0.5], mu=0.9, decay=0.01, class_weights=CLASS_WEIGHTS)} {_weights_sql('w3')}""",
    "c03_fit_mlp": _hidden_sql(MLP_STEPS, 0.2, 0.9),
    "c04_boosted_binary": _trees_sql(_Y, FOUR, "binary:logistic", 2, 2),
    "c05_boosted_multiclass": _trees_sql(_CODE, FOUR, "multi:softprob", 2, 2, outputs=3, base=0.5),
    "c06_boosted_squared": _trees_sql("l_quantity", FOUR[1:], "reg:linear", 2, 2, base=25.0),
    "c07_boosted_logistic_target": _trees_sql("l_discount * 10", ["l_quantity", "l_tax", "l_linenumber"], "reg:logistic", 2, 2),
    "c08_dart": _trees_sql(_Y, FOUR, "binary:logistic", 4, 1, drop=0.5, seed=DART_SEED),
    "c09_linear_booster": _linear_sql(FOUR, 3),
    "c10_booster_parameters": _trees_sql(
        _Y, FOUR, "binary:logistic", 2, 2, eta=0.1, lam=2.0, alpha=1.0, gamma=0.01, child=100, step=0.005, subsample=0.7,
        colsample=0.5, seed=4, weight="CASE l_linestatus WHEN 'O' THEN 1.02::DOUBLE ELSE 1::DOUBLE END",
    ),
    "c22_exact_cuts": _trees_sql(_Y, ["l_extendedprice", "l_quantity"], "binary:logistic", 2, 2),
    "c23_weighted_cuts": " UNION ALL ".join(
        f"SELECT DISTINCT {f} AS f, cut FROM (SELECT min(v) AS cut FROM ("
        f"SELECT v, sum(w) OVER (ORDER BY v) AS upto, sum(w) OVER () AS whole FROM (SELECT {c}::DOUBLE AS v, sum(l_extendedprice) AS w "
        f"FROM lineitem GROUP BY 1)), range(1, {CUT_BINS}) k(i) WHERE upto >= whole * i / {CUT_BINS} * (1 - 1e-12) GROUP BY i)"
        for f, c in enumerate(FOUR)
    ),
    "c24_boosted_sparse": _trees_sql(_Y, [f"nullif({c}, 0)" for c in FOUR], "binary:logistic", 2, 2, missing=True),
    "c11_solver_rules": f"WITH {X_SQL}, "
    + ", ".join(
        softmax_chain(2, [0.1, 0.1], rule, 0.9 if rule in ("SGD", "NESTEROV") else 0.0, tag=f"_{rule}_") for rule in RULES
    )
    + " UNION ALL ".join(
        f" SELECT '{r}' AS rule, f::INT AS f, k::INT AS k, round(w, 6) + 0.0 AS w FROM w_{r}_2" for r in RULES
    ),
    "c12_lr_schedule": """
WITH e AS (SELECT event_id, CAST(props->>'k' AS INT) AS t FROM events)
SELECT event_id, 0.1::DOUBLE AS fixed, round(0.1::DOUBLE * pow(0.5, t // 20), 6) AS step,
       round(0.1::DOUBLE * pow(1 + 0.05::DOUBLE * t, -0.75), 6) AS inv FROM e""",
    "c13_weight_decay": f"WITH {X_SQL}, {softmax_chain(2, decay=0.1)} {_weights_sql('w2')}",
    "c14_periodic_evaluation": f"WITH {X_SQL}, {softmax_chain(2)}, "
    "xs AS (SELECT row_id, label, f, v, CASE split WHEN 'test' THEN 'val_1' ELSE 'val_2' END AS split FROM x), "
    + ", ".join(f"{probabilities(f'e{t}', f'w{t}', 'xs')}, {predictions(f'd{t}', f'e{t}')}" for t in range(3))
    + " UNION ALL ".join(_eval_sql(t) for t in range(3))
    + "".join(
        f" UNION ALL SELECT {t + 1}, 'train', 'train_loss', {_loss_sql(t)}" for t in range(2)
    ),
    "c15_snapshots": f"""
WITH {X_SQL}, {softmax_chain(2)}
SELECT 1::BIGINT AS iteration, f::INT AS f, k::INT AS k, round(w, 6) + 0.0 AS w FROM w1
UNION ALL SELECT 2, f::INT, k::INT, round(w, 6) + 0.0 FROM w2""",
    "c16_resume": f"WITH {X_SQL}, {softmax_chain(3, mu=0.9)} {_weights_sql('w3')}",
    "c17_start_from_snapshot": f"""
WITH {X_SQL}, {softmax_chain(1)}, {probabilities('prob', 'w1', 'x')}, {predictions('d', 'prob')}
SELECT row_id, pred::INT AS pred FROM d""",
    "c18_refit": f"WITH {X_SQL}, {softmax_chain(2)} "
    + " UNION ALL ".join(
        f"SELECT 'again_{run}' AS log, {t + 1}::DOUBLE AS iteration, {_loss_sql(t)} AS train_loss"
        for run in (1, 2) for t in range(2)
    ),
    "c19_regression": f"""
WITH d AS (
  SELECT row_number() OVER () AS id, l_extendedprice / 100000 AS y, unnest(range(4)) AS f,
         unnest([{', '.join(f'({c})::DOUBLE' for c in _LINEAR_COLUMNS)}]) AS v FROM (SELECT * FROM lineitem)),
{_regression_chain(2, 0.5)}
SELECT f::INT AS f, 0 AS k, round(w, 6) + 0.0 AS w FROM r2""",
    "c20_training_log": f"WITH {X_SQL}, {softmax_chain(3)} "
    + " UNION ALL ".join(
        f"SELECT {t + 1}::DOUBLE AS iteration, 'train_loss' AS metric, {_loss_sql(t)} AS value" for t in (1, 2)
    ),
    "c21_minibatches": _minibatch_sql(10),
    "c25_table_of_weights": _minibatch_sql(4),
}
