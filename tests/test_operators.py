import random

import pytest
from pyspark.sql import functions as F

from gradloom import session
from gradloom.functions.schedules import rate_at, rate_column
from gradloom.operators import metrics, runlog
from gradloom.operators.ordering import dense_positions, number_by_hash, prefix_sum, shuffle_rows
from gradloom.operators.prepare import (
    StandardScaler,
    assign_minibatch,
    bounds_of,
    categorical_apply,
    categorical_entries,
    categorical_fit,
    csv_test_split,
    mark_smoothed,
    minmax_apply,
    minmax_fit,
    train_test_split,
)
from gradloom.operators.vocabulary import text_features


def test_prefix_sum_and_positions(spark):
    rng = random.Random(3)
    keys = rng.sample(range(100_000), 3000)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k bigint, n bigint").repartition(13)
    got = {r.k: r.before for r in prefix_sum(df, ["k"], "n", "before").collect()}
    total, expected = 0, {}
    for k in sorted(keys):
        expected[k] = total
        total += k % 7
    assert got == expected
    assert {r.k: r.position for r in dense_positions(df, ["k"]).collect()} == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_hash_numbers_do_not_depend_on_partitions(spark, parts):
    df = spark.range(2000).withColumnRenamed("id", "row_id").repartition(parts)
    got = [r.row_id for r in number_by_hash(df, 9).orderBy("position").collect()]
    assert [r.position for r in number_by_hash(df, 9).select("position").orderBy("position").collect()] == list(range(2000))
    again = [r.row_id for r in shuffle_rows(df, 9).collect()]
    assert got == again and got != sorted(got)
    assert sorted(r.row_id for r in shuffle_rows(df, -1).collect()) == list(range(2000))


def test_minibatches(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    sizes = {r.batch_id: r["count"] for r in assign_minibatch(df, 150, 2, 4).groupBy("batch_id").count().collect()}
    assert sizes == {0: 300, 1: 300, 2: 300, 3: 100}


def test_splits(spark):
    df = spark.range(5000).withColumnRenamed("id", "row_id")
    share = train_test_split(df, 0.2, 1337).where("split = 'test'").count() / 5000
    assert 0.17 < share < 0.23
    for shuffle in (False, True):
        assert csv_test_split(df, 0.3, shuffle, 5).where("split = 'test'").count() == 1500
    assert csv_test_split(df, 0.0).where("split = 'test'").count() == 0


def test_scalers(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "features array<double>")
    assert sorted(r.features for r in StandardScaler.fit(df).apply(df).collect()) == [[-1.0, 0.0], [1.0, 0.0]]
    cols = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    assert sorted(tuple(r) for r in minmax_apply(cols, bounds_of(minmax_fit(cols, ["a", "b"]))).collect()) == [(0.0, 0.0), (1.0, 0.0)]


def test_categoricals(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "u string, v string")
    mapping = categorical_fit(df.where("u <> 'c'"), ["u", "v"])
    rows = categorical_apply(df, mapping, ["u", "v"]).collect()
    assert sorted((r.u, r.v) for r in rows) == [([0.0, 0.0], [0.0]), ([0.0, 1.0], [1.0]), ([1.0, 0.0], [1.0])]


def test_category_maps_of_any_size_give_the_same_rows(spark, monkeypatch):
    """Long values count by their bytes: a map beyond the bound is joined by a shuffle."""
    rng = random.Random(1)
    df = spark.createDataFrame([(i, rng.choice("abc") * 900, rng.choice(["x", None, "z"])) for i in range(200)], "id int, u string, v string")
    mapping = categorical_fit(df.where("id > 2"), ["u", "v"]).cache()

    def rows():
        dense, sparse = (f(df, mapping, ["u", "v"]) for f in (categorical_apply, categorical_entries))
        plan = dense._jdf.queryExecution().executedPlan().toString()
        return [sorted(map(tuple, f.collect())) for f in (dense, sparse)], "BroadcastHashJoin" in plan

    small, shipped = rows()
    monkeypatch.setattr(session, "BROADCAST_BYTES", 1000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large, still = rows()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert small == large and shipped and still  # the short column still travels, the long one does not


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 28])
def test_idle_runs_of_long_logs_are_cut_by_lines(spark, monkeypatch, broadcast_bytes):
    rng = random.Random(2)
    times = {"hot": [rng.uniform(0, 3000) for _ in range(900)], "burst": [5.0 + rng.random() for _ in range(400)], "short": [1.0, 50.0], None: [3.0] * 5}
    lines = spark.createDataFrame([(log, t) for log, ts in times.items() for t in ts], "log string, at double").repartition(7)
    plain = {r.log: r for r in runlog.idle_runs(lines.where("log IS NOT NULL"), 10.0).collect()}
    monkeypatch.setattr(runlog, "SEGMENT_LINES", 50)
    monkeypatch.setattr(session, "BROADCAST_BYTES", broadcast_bytes)
    cut = {r.log: r for r in runlog.idle_runs(lines.where("log IS NOT NULL"), 10.0).collect()}
    assert cut == plain and set(cut) == {"hot", "burst", "short"}
    for log, row in cut.items():
        ts = sorted(times[log])
        gaps = [a for a, b in zip(ts, ts[1:]) if b - a > 10.0]
        assert (row.gaps, row.last_line) == (len(gaps), gaps[0] if gaps else ts[-1])


@pytest.mark.parametrize("shipped", [0, 1 << 20])
def test_text_features(spark, shipped):
    df = spark.createDataFrame([(0, "The cat  the\ndog"), (1, "")], "row_id bigint, text string")
    rows, vocabulary = text_features(df, broadcast_bytes=shipped)
    words = {r.position: r.feature for r in vocabulary.collect()}
    got = {r.row_id: {words[i]: v for i, v in zip(r.indices, r["values"])} for r in rows.collect()}
    assert got == {0: {"the": 2.0, "cat": 1.0, "dog": 1.0}, 1: {}}


def test_schedules(spark):
    with pytest.raises(ValueError):
        rate_at("poly", 1, 0.1)
    args = {"fixed": {}, "step": {"gamma": 0.1, "stepsize": 30}, "inv": {"gamma": 0.01, "power": 0.75}}
    for policy, options in args.items():
        column = spark.range(100).select(rate_column(policy, F.col("id"), 0.1, **options).alias("r"))
        assert [r.r for r in column.collect()] == pytest.approx([rate_at(policy, t, 0.1, **options) for t in range(100)])


def _scored(spark, rows):
    return metrics.with_prediction(spark.createDataFrame(rows, "split string, label int, scores array<double>"))


def test_auc_ties_and_skew(spark):
    """Brute force over pairs, with one score on a third of the rows."""
    rng = random.Random(1)
    rows = [("s", rng.randint(0, 1), 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(600)]
    scored = _scored(spark, [(s, y, [1 - p, p]) for s, y, p in rows])
    pos, neg = [p for _, y, p in rows if y], [p for _, y, p in rows if not y]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert metrics.area_under_curve(scored, 2).head().value == pytest.approx(expected, abs=1e-12)


def test_metrics_of_degenerate_sets(spark):
    scored = _scored(spark, [("s", 0, [0.9, 0.1, 0.0]), ("s", 0, [1.0, 0.0, 0.0])])
    found = {r.metric: r.value for r in metrics.evaluate_sets(scored, ["acc", "precision", "recall", "f1", "mcc", "mcll"], 3).collect()}
    assert found["acc"] == 1.0 and found["mcc"] == 0.0
    assert found["f1"] == pytest.approx(1 / 3) and found["mcll"] == pytest.approx(0.0526803, abs=1e-6)
    with pytest.raises(ValueError):
        metrics.evaluate_sets(scored, ["rmse"], 3)


LINES = [
    "{'iteration': 1, 'mcll': 2.0, 'other': 5}", "noise", "{'iteration': 1, 'mcll': 1.9}", "{'iteration': 3, 'acc': NaN}",
    "{'iteration': 2, 'mcll': 1}", "{'iteration': 0, 'mcll': 1}", "{'iteration': 4, 'mcll': nan}", "{'iteration': 5, 'm",
    "{'mcll': 1.0}", "{'status': {'iteration': 9}}", "{'iteration': true, 'mcll': 1.0}", "{'iteration': NaN, 'mcll': 1.0}", "{'iteration': 7.5, 'auc': 0.5}",
]


@pytest.mark.parametrize("segment", [1, 2, 1000])
def test_log_lines(spark, segment):
    lines = spark.createDataFrame([("a", i, v) for i, v in enumerate(LINES)], "log string, line_no bigint, value string")
    parsed = runlog.parse_lines(lines)
    bad = runlog.count_bad_lines(parsed).head()
    assert (bad.lines, bad.rejected) == (13, 7)
    kept = runlog.monotonic_filter(runlog.drop_bad_lines(parsed), segment)
    assert sorted(r.iteration for r in kept.collect()) == [1.0, 3.0, 7.5]
    points = runlog.unpivot_metrics(kept)
    assert {(r.iteration, r.metric) for r in points.collect()} == {(1.0, "mcll"), (3.0, "acc")}
    curves = runlog.metric_curves(points, lines)
    assert curves.count() == 9 + 2


def _running(values):
    top, kept = 0, []
    for v in values:
        if v > top:
            kept.append(v)
            top = v
    return kept


@pytest.mark.parametrize("segment", [7, 50, 10_000])
def test_long_log_is_cut_without_change(spark, segment):
    """One log holds most lines; every segment length gives the sequential result."""
    rng = random.Random(5)
    logs = {"hot": [rng.randint(0, 3000) + i for i in range(2000)], "cold": [3, 2, 5]}
    rows = [(log, i, float(v)) for log, values in logs.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "log string, line_no bigint, iteration double").repartition(9)
    kept = runlog.monotonic_filter(df, segment).orderBy("line_no").collect()
    for log, values in logs.items():
        assert [r.iteration for r in kept if r.log == log] == _running(values)


@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
@pytest.mark.parametrize("last", [1, 2, 5])
def test_smoothing_is_cut_without_change(spark, chunk, last):
    rng = random.Random(chunk)
    rows = [("a", float(i), rng.random()) for i in sorted(rng.sample(range(1, 200), 60))] + [("b", 2.0, 4.0)]
    df = spark.createDataFrame(rows, "log string, iteration double, value double")
    segment = F.floor(F.col("iteration") / chunk)
    got = {r.iteration: r.m for r in mark_smoothed(df, "log", "iteration", "value", last, segment, "m").where("log = 'a'").collect()}
    series = [v for log, _, v in rows if log == "a"]
    means = [sum(series[max(0, i - last + 1) : i + 1]) / min(i + 1, last) for i in range(len(series))]
    assert [got[i] for log, i, _ in rows if log == "a"] == pytest.approx(means)


def test_idle_runs(spark):
    df = spark.createDataFrame([("a", t) for t in (0.0, 5.0, 24.0, 45.0, 46.0)] + [("b", 1.0)], "log string, at double")
    got = {r.log: (r.last_line, r.ended, r.gaps) for r in runlog.idle_runs(df, 20.0, segment=F.floor(F.col("at") / 3)).collect()}
    assert got == {"a": (24.0, 44.0, 1), "b": (1.0, 21.0, 0)}


def test_registrations(spark):
    rows = [("Net", "2024-01-01 00:00:00", "p1"), ("net", "2024-01-02 00:00:00", "p2"), ("", "2024-01-03 04:05:06", "p3")]
    df = spark.createDataFrame(rows, "name string, created_at string, path string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    got = {r.name: r.path for r in runlog.latest_registration(df).collect()}
    assert got == {"net": "p2", "run_2024-01-03-04-05-06-000000": "p3"}


def test_history_and_latest(spark):
    points = spark.createDataFrame([("a", 1.0, "acc", 0.1), ("a", 12.0, "acc", 0.3), ("a", 5.0, "acc", 0.2)], "log string, iteration double, metric string, value double")
    chunks = {r.chunk: (r.iterations, r["values"]) for r in runlog.measure_history(points, 10).collect()}
    assert chunks == {0: ([1.0, 5.0], [0.1, 0.2]), 1: ([12.0], [0.3])}
    assert runlog.latest_measure(points).head().value == 0.3


def test_words_are_cut_and_counted_in_a_batch(spark):
    """Only distinct words of a batch leave it; runs of the four blanks part words, other white space does not."""
    import pyarrow as pa

    from gradloom.operators import vocabulary

    texts = ["a  b\ta", "", " \r\n", "b\x0bc b", "a"]
    batch = pa.RecordBatch.from_pydict({"row_id": pa.array(range(5), pa.int64()), "text": texts})
    (words,) = vocabulary._distinct_words([batch])
    assert sorted(words.column("feature").to_pylist()) == ["a", "b", "b\x0bc"]
    (counted,) = vocabulary._count_words([batch])
    got = [dict(zip(r["words"], r["values"])) for r in counted.to_pylist()]
    assert got == [{"a": 2.0, "b": 1.0}, {}, {}, {"b\x0bc": 1.0, "b": 1.0}, {"a": 1.0}]
    rows = spark.createDataFrame([*enumerate(texts), (5, None)], "doc_id long, text string")
    for limit in (0, 1000):
        features, known = vocabulary.text_features(rows, "text", "doc_id", limit)
        place = {r.position: r.feature for r in known.collect()}
        found = {r.row_id: {place[i]: v for i, v in zip(r.indices, r["values"])} for r in features.collect()}
        assert found == {**dict(enumerate(got)), 5: {}}
