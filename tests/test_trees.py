"""Growers, cuts and missing values of boosted trees against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradloom.functions.vectors import dense_to_sparse
from gradloom.plans import boosting
from gradloom.plans.booster import BoostedModel
from gradloom.plans.cells import Tower, cuts_of, joined, pruned, weighted_edges
from gradloom.sources.svmlight import read_svmlight, write_svmlight


def table(spark, x, y):
    return spark.createDataFrame([(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, y))], "row_id bigint, features array<double>, label int")


def grown(df, rounds=2, **options):
    model = BoostedModel(2)
    model.fit(df, objective="binary:logistic", iterations=rounds, max_depth=3, test_interval=0, **options)
    return [(t.feature, [round(v, 9) for v in t.threshold], t.missing, np.round(t.value, 9).tolist()) for trees in model.model.rounds for t in trees]


def plain_tree(x, g, h, depth, eta=0.3):
    """Greedy exact tree; NaN goes to the better side. Nested (feature, cut, missing_left, left, right) or a leaf value."""
    best = (1e-12, None)
    for f in range(x.shape[1]):
        missing = np.isnan(x[:, f])
        for cut in np.unique(x[~missing, f]):
            for side in (False, True) if missing.any() else (False,):
                left = np.where(missing, side, x[:, f] <= cut)
                sums = [(g[m].sum(), h[m].sum()) for m in (left, ~left, slice(None))]
                if min(sums[0][1], sums[1][1]) < 1 or left.all() or not left.any():
                    continue
                gain = 0.5 * (sum(a * a / (b + 1) for a, b in sums[:2]) - sums[2][0] ** 2 / (sums[2][1] + 1))
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (f, float(cut), side, left))
    if best[1] is None or not depth:
        return -eta * g.sum() / (h.sum() + 1)
    f, cut, side, left = best[1]
    return (f, cut, side, plain_tree(x[left], g[left], h[left], depth - 1), plain_tree(x[~left], g[~left], h[~left], depth - 1))


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    children = [nested(tree, tree.left[node] + k) for k in range(2)]
    return (tree.feature[node], tree.threshold[node], bool(tree.missing[node]), *children)


def assert_same(found, expected):
    if isinstance(expected, tuple):
        assert found[:3] == expected[:3]
        for a, b in zip(found[3:], expected[3:]):
            assert_same(a, b)
    else:
        assert found == pytest.approx(expected)


def data(seed, rows=400, distinct=7, holes=0.2):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, distinct, size=(rows, 4)).astype(float)
    y = ((x[:, 0] > distinct / 2) ^ (x[:, 1] > distinct / 3)).astype(int)
    x[rng.random(x.shape) < holes] = np.nan
    return x, y


@pytest.mark.parametrize("method", ["hist", "exact", "approx"])
@pytest.mark.parametrize("budget", [boosting.HISTOGRAM_BYTES, 0])
def test_missing_cells_go_to_the_better_side(spark, monkeypatch, method, budget):
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", budget)
    x, y = data(1)
    model = BoostedModel(2)
    df = table(spark, x, y).repartition(5)
    model.fit(df, objective="binary:logistic", iterations=1, max_depth=3, tree_method=method, test_interval=0)
    assert_same(nested(model.model.rounds[0][0]), plain_tree(x, 0.5 - y, np.full(len(y), 0.25), 3))
    scored = {r.row_id: r.scores[1] for r in model.predict_proba(df).collect()}
    again = BoostedModel(2, repository=model.repository)
    assert {r.row_id: r.scores[1] for r in again.predict_proba(df).collect()} == scored


def test_exact_trees_try_every_value(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 > 0.3).astype(int)
    model = BoostedModel(2)
    model.fit(table(spark, x, y).repartition(7), objective="binary:logistic", iterations=1, max_depth=3, tree_method="exact", test_interval=0)
    assert_same(nested(model.model.rounds[0][0]), plain_tree(x, 0.5 - y, np.full(len(y), 0.25), 3))


def test_table_of_histograms_grows_the_same_trees(spark, monkeypatch):
    x, y = data(3, rows=900, distinct=30)
    df = table(spark, x, y)
    plain = grown(df, rounds=3, subsample=0.8, colsample=0.7)
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 0)
    assert grown(df.repartition(6), rounds=3, subsample=0.8, colsample=0.7) == plain


@pytest.mark.parametrize("budget", [boosting.HISTOGRAM_BYTES, 0])
def test_sparse_rows_grow_the_trees_of_dense_ones(spark, monkeypatch, budget):
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", budget)
    rng = np.random.default_rng(4)
    x = np.where(rng.random((500, 6)) < 0.6, 0.0, rng.integers(-4, 5, size=(500, 6)))
    y = (x[:, 0] + x[:, 1] > 0).astype(int)
    df = table(spark, x, y)
    assert grown(dense_to_sparse(df)) == grown(df)
    holes = np.where(x == 0.0, np.nan, x)
    assert grown(dense_to_sparse(df), absent="missing") == grown(table(spark, holes, y))


def test_wide_svmlight_rows_are_never_made_dense(spark, tmp_path, monkeypatch):
    """A hundred thousand columns, some ten cells a row."""
    from gradloom.plans import cells

    def refuse(*_):
        raise AssertionError("dense rows")

    monkeypatch.setattr(boosting, "dense_rows", refuse)
    monkeypatch.setattr(cells, "DenseCells", refuse)
    ids = F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(10)), lambda k: F.pmod(F.xxhash64("id", k), F.lit(99_999)).cast("int"))))
    flag = F.col("id") % 3 == 0
    rows = spark.range(2000).select(
        flag.cast("int").alias("label"), F.when(flag, F.array_union(F.array(F.lit(99_999)), ids)).otherwise(ids).alias("indices")
    )
    rows = rows.withColumn("indices", F.array_sort("indices")).withColumn("values", F.transform("indices", lambda i: F.lit(1.5)))
    write_svmlight(rows, str(tmp_path / "wide.svm"))
    train = read_svmlight(spark, str(tmp_path / "wide.svm"))
    model = BoostedModel(2)
    model.fit(train, objective="binary:logistic", iterations=2, max_depth=2, test_interval=0)
    assert model.model.width == 100_000 and model.model.rounds[0][0].feature[0] == 99_999
    assert model.predict(train).where("pred <> label").count() == 0


def test_validation_margins_equal_whole_ensembles(spark):
    x, y = data(5)
    df = table(spark, x, y)
    for booster, more in (("gbtree", {}), ("dart", {"drop_rate": 0.5})):
        model = BoostedModel(2)
        log = model.fit(df, [df.where("row_id % 3 = 0")], objective="binary:logistic", booster=booster, iterations=12, max_depth=2, metrics=("mcll",), test_interval=4, seed=3, **more)
        held = {r.iteration: r.value for r in log.where("metric = 'mcll'").collect()}
        scored = model.predict_proba(df.where("row_id % 3 = 0"))
        loss = scored.agg(F.avg(-F.log(F.get("scores", F.col("label"))))).head()[0]
        assert set(held) == {4.0, 8.0, 12.0} and held[12.0] == pytest.approx(loss)


def test_weighted_cuts_are_ranks_of_the_weight(spark):
    rng = np.random.default_rng(6)
    x, w = rng.integers(0, 40, 3000).astype(float), rng.random(3000)
    df = spark.createDataFrame([([float(a)], float(b)) for a, b in zip(x, w)], "features array<double>, w double").repartition(6)
    order = np.argsort(x)
    ends = np.cumsum(w[order])
    plain = np.unique([x[order][np.searchsorted(ends, ends[-1] * i / 16)] for i in range(1, 16)])
    assert weighted_edges(df, 1, 16, weight="w")[0].tolist() == plain.tolist()
    assert weighted_edges(df.limit(0), 1, 16)[0].tolist() == []


def test_summaries_keep_ranks(spark):
    rng = np.random.default_rng(7)
    tower, parts = Tower(512), []
    for _ in range(40):
        values = np.sort(rng.normal(size=2000))
        weights = rng.random(2000)
        parts.append((values, weights))
        tower.add(*pruned(values, weights, 512))
    whole, held = joined(parts), tower.whole()
    total = whole[1].sum()
    assert held[1].sum() == pytest.approx(total) and len(held[0]) <= 512 * 6
    for cut, share in zip(cuts_of(*held, 10), np.arange(1, 10) / 10):
        assert abs(whole[1][whole[0] <= cut].sum() / total - share) < 0.02


def test_empty_columns_and_constant_labels(spark):
    df = table(spark, np.full((20, 2), np.nan), np.ones(20))
    for method in ("hist", "approx", "exact"):
        model = BoostedModel(2)
        model.fit(df, objective="binary:logistic", iterations=2, max_depth=2, tree_method=method, test_interval=0)
        assert all(t.feature == [-1] for trees in model.model.rounds for t in trees)
    with pytest.raises(ValueError, match="tree_method"):
        BoostedModel().fit(df, tree_method="fast")
