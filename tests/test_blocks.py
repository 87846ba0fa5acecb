"""Training rows as blocks of bytes: few rows a pass, sources read once, exact cuts by stretches of values."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_trees import assert_same, data, grown, nested, plain_tree, table

from gradloom.functions.vectors import dense_to_sparse, format_value, sparse_to_text
from gradloom.plans import boosting, histograms
from gradloom.plans.booster import BoostedModel
from gradloom.sources.svmlight import read_svmlight, write_svmlight


def many_rows(spark, rows=20_000):
    cells = [F.pmod(F.xxhash64("id", F.lit(j)), F.lit(5)).cast("double") for j in range(3)]
    return spark.range(rows).select(F.col("id").alias("row_id"), F.array(*cells).alias("features"), (cells[0] > cells[1]).cast("int").alias("label"))


@pytest.mark.parametrize("options", [{}, {"booster": "dart", "drop_rate": 0.5, "subsample": 0.9}, {"tree_method": "approx"}, {"tree_method": "exact"}])
def test_passes_go_over_few_rows(spark, monkeypatch, options):
    """what a pass reads are blocks, not rows, and all rows are in them."""
    seen, plain = [], boosting.grow_round

    def spy(rows, *more, **named):
        seen.append((rows.count(), rows.agg(F.sum("rows")).head()[0]))
        return plain(rows, *more, **named)

    monkeypatch.setattr(boosting, "grow_round", spy)
    df = many_rows(spark)
    trees = grown(df, **options)
    assert len(seen) == 2 and all(blocks <= 200 and rows == 20_000 for blocks, rows in seen)
    if options.get("booster") != "dart":
        assert trees[0][0][0] in (0, 1)


def test_small_blocks_grow_the_same_trees(spark, monkeypatch):
    from gradloom.plans import blocks

    x, y = data(8, rows=900)
    df = table(spark, x, y)
    for rows in (df, dense_to_sparse(df)):
        plain = grown(rows, subsample=0.8)
        with monkeypatch.context() as patch:
            patch.setattr(blocks, "BLOCK_BYTES", 1000)
            assert grown(rows, subsample=0.8) == plain


@pytest.mark.parametrize("held", [1, 1 << 19])
def test_exact_cuts_over_many_stretches(spark, monkeypatch, held):
    """F8: sums go on from stretch to stretch; one row a stretch reaches the driver, and none for single values."""
    monkeypatch.setattr(boosting, "RANGE_ROWS", 50, raising=False)
    monkeypatch.setattr(histograms, "HELD_VALUES", held, raising=False)
    ends, plain = [], histograms._carried

    def spy(rows, *more):
        ends.append(len(rows))
        return plain(rows, *more)

    monkeypatch.setattr(histograms, "_carried", spy)
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=700), rng.integers(0, 3, 700), np.full(700, 2.0)])
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 > 0.3).astype(int)
    x[rng.random(x.shape) < 0.1] = np.nan
    model = BoostedModel(2)
    model.fit(table(spark, x, y).repartition(5), objective="binary:logistic", iterations=1, max_depth=3, tree_method="exact", test_interval=0)
    assert_same(nested(model.model.rounds[0][0]), plain_tree(x, 0.5 - y, np.full(len(y), 0.25), 3))
    assert all(10 < n <= 14 + 4 + 2 for n in ends)


@pytest.mark.parametrize("absent", ["zero", "missing"])
def test_sparse_rows_are_read_once(spark, absent):
    """cuts and bins come from one reading of the source."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = dense_to_sparse(many_rows(spark, 3000))
    rows = rows.mapInArrow(count, rows.schema)
    grown(rows, num_feature=3, absent=absent)
    assert read.value == 3000


def test_text_of_values_is_that_of_each(spark):
    values = [1.0, 10.0, -2.0, 0.05, 1.05, 1e10, 1e-7, 100.0, float("nan"), float("inf"), 0.0, -0.0, 3.0]
    df = spark.createDataFrame([(list(range(len(values))), values), ([], []), ([7], [5.0])], "indices array<int>, values array<double>")
    single = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(format_value(F.col("v"))).collect()]
    lines = [r[0] for r in df.select(sparse_to_text()).collect()]
    assert lines == [" ".join(f"{i}:{v}" for i, v in enumerate(single)), "", "7:5"]


def test_tabs_blanks_and_comments_of_svmlight(spark, tmp_path):
    (tmp_path / "a.svm").write_text("1 0:2 \t 3:4.5\n\n   \n# none\n0\t1:1 # 2:2\n2\n")
    rows = sorted(tuple(r) for r in read_svmlight(spark, str(tmp_path / "a.svm")).collect())
    assert rows == [(0, 1, [0, 3], [2.0, 4.5]), (1, 0, [1], [1.0]), (2, 2, [], [])]
    write_svmlight(read_svmlight(spark, str(tmp_path / "a.svm")).coalesce(1), str(tmp_path / "b.svm"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "b.svm")).collect()) == ["0 1:1", "1 0:2 3:4.5", "2"]


@pytest.mark.parametrize("options", [{"booster": "dart", "drop_rate": 0.5}, {"objective": "reg:linear", "base_score": 0.3}])
def test_training_loss_comes_from_blocks(spark, monkeypatch, options):
    """no training row is scored outside of its block for the log, and the log is right."""
    seen, plain = [], BoostedModel._measure

    def spy(self, scored, wanted):
        seen.append(scored.count())
        return plain(self, scored, wanted)

    monkeypatch.setattr(BoostedModel, "_measure", spy)
    df, model = many_rows(spark), BoostedModel(2)
    log = model.fit(df, **{"objective": "binary:logistic", "iterations": 3, "max_depth": 2, "seed": 2} | options)
    assert not seen
    found = {r.iteration: (r.metric, r.value) for r in log.collect()}
    rows = model.predict_proba(df).select("label", "scores").toPandas()
    scores, label = np.stack(rows["scores"].to_list()), rows["label"].to_numpy()
    error = (scores[:, 0] - label) ** 2 / 2 if "objective" in options else -np.log(scores[np.arange(len(label)), label])
    assert sorted(found) == [1.0, 2.0, 3.0] and found[3.0] == ("train_loss", pytest.approx(error.mean(), rel=1e-9))


def test_a_level_goes_over_the_rows_once(spark, monkeypatch):
    """totals come with the pass that caches a round's rows, not with one of their own."""
    passes, plain = [], histograms.sum_partials

    def spy(df, *more):
        passes.append(df.columns)
        return plain(df, *more)

    monkeypatch.setattr(histograms, "sum_partials", spy)
    grown(many_rows(spark), rounds=3, booster="dart", drop_rate=0.5)
    assert passes == [["rows", "cells", "g", "h"]] * 9
