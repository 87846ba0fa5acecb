import math
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gradloom import session
from gradloom.functions.logs import ROLLED_FILE_PATTERN, log_name
from gradloom.functions.vectors import (
    class_weight,
    dense_to_sparse,
    format_value,
    format_value_16g,
    predicted_class,
    sparse_to_dense,
    sparse_to_text,
)
from gradloom.operators.scores import best_n, best_n_scores, long_scores, scatter_scores
from gradloom.operators.vocabulary import apply_vocabulary, feature_vocabulary
from gradloom.session import scratch_path
from gradloom.sources import textlines
from gradloom.sources.journals import read_run_logs
from gradloom.sources.svmlight import read_svmlight, read_svmlight_unlabelled, write_svmlight
from gradloom.sources.tables import from_dense, from_triples, materialize_features, read_csv_features, with_targets
from gradloom.sources.textlines import read_lines, with_row_id


def write_file(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_svmlight_edge_rows(spark, tmp_path):
    path = write_file(tmp_path, "a.svm", "1 0:0.5 3:-2e-3 # note\n3\n\n0 1:1 1:2\n# only a note\n2.0 5:0.0\n")
    rows = read_svmlight(spark, path).orderBy("row_id").collect()
    assert [(r.row_id, r.label, r.indices, r["values"]) for r in rows] == [
        (0, 1, [0, 3], [0.5, -0.002]), (1, 3, [], []), (2, 0, [1, 1], [1.0, 2.0]), (3, 2, [5], [0.0])
    ]
    assert read_svmlight(spark, path, zero_based=False).where("row_id = 0").head().indices == [-1, 2]


def test_svmlight_unlabelled_keeps_empty_rows(spark, tmp_path):
    path = write_file(tmp_path, "a.svm", "0:1\n\n2:3 4:5\n\n")
    rows = read_svmlight_unlabelled(spark, path).orderBy("row_id").collect()
    assert [(r.row_id, r.indices) for r in rows] == [(0, [0]), (1, []), (2, [2, 4]), (3, [])]


def test_svmlight_missing_path_and_bad_value(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_svmlight(spark, str(tmp_path / "none.svm")).count()
    path = write_file(tmp_path, "bad.svm", "1 0:x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_svmlight(spark, path).collect()


def test_round_trip_keeps_every_double(spark):
    values = [0.1, 1 / 3, 1e-300, -2.5e10, 0.30000000000000004, 5e-324, 12345678.9]
    df = spark.createDataFrame([(0, 4, list(range(7)), values)], "row_id bigint, label int, indices array<int>, values array<double>")
    path = scratch_path(spark, "t")
    write_svmlight(df, path)
    row = read_svmlight(spark, path).head()
    assert row["values"] == values and row.label == 4


def test_row_ids_follow_files_and_splits(spark, tmp_path):
    for i, n in enumerate((3000, 1, 2000)):
        write_file(tmp_path, f"p-{i}.txt", "".join(f"{i}:{j}\n" for j in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        got = [r.value for r in with_row_id(lines).orderBy("row_id").collect()]
        fresh = with_row_id(lines, group=lambda path: path).groupBy("file_path").agg(F.max("row_id").alias("m")).orderBy("file_path").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"{i}:{j}" for i, n in enumerate((3000, 1, 2000)) for j in range(n)]
    assert [r.m for r in fresh] == [2999, 0, 1999]


def test_many_splits_are_added_up_where_they_lie(spark, tmp_path, monkeypatch):
    rng = random.Random(0)
    for i in (2, 10, 1):
        for log in "ab":
            write_file(tmp_path, f"{log}-{i}.txt", "".join(f"{log}{i}:{j}{'x' * rng.randint(0, 40)}\n" for j in range(rng.randint(0, 900))))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        near = [sorted(map(tuple, f().collect())) for f in (lambda: with_row_id(read_lines(spark, str(tmp_path))), lambda: read_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN))]
        monkeypatch.setattr(textlines, "DRIVER_SPLITS", 3)
        far = [with_row_id(read_lines(spark, str(tmp_path))), read_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN)]
        assert [sorted(map(tuple, f.collect())) for f in far] == near
        monkeypatch.setattr(session, "BROADCAST_BYTES", 10)
        assert sorted(map(tuple, with_row_id(read_lines(spark, str(tmp_path))).collect())) == near[0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_no_line_moves_for_a_hundred_thousand_splits(spark):
    splits, held = 120_000, 2
    place = F.col("id").cast("bigint")
    lines = spark.range(splits * held, numPartitions=8).select(
        F.concat(F.lit("f"), F.lpad((place / held / 100).cast("int").cast("string"), 6, "0")).alias("file_path"),
        ((place / held).cast("int") % 100).cast("bigint").alias("block"), place.alias("seq"), place.alias("value"),
    )
    numbered = with_row_id(lines)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning(file_path" not in plan.split("BroadcastExchange")[0]
    assert numbered.where("row_id = value").count() == splits * held


def test_changed_splits_fail_loudly(spark, tmp_path):
    path = write_file(tmp_path, "a.txt", "x\n" * 2000)
    numbered = with_row_id(read_lines(spark, path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        with pytest.raises(Exception, match="file splits changed"):
            numbered.select("*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_dense_sparse_edges(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0, -0.0, float("nan"), -2.0])], "row_id bigint, features array<double>")
    row = dense_to_sparse(df).head()
    assert row.indices == [0, 3, 4] and row["values"][0] == 1.0 and math.isnan(row["values"][1])
    back = sparse_to_dense(dense_to_sparse(df), 4).head().features
    assert back[:3] == [1.0, 0.0, 0.0] and math.isnan(back[3]) and len(back) == 4
    twice = spark.createDataFrame([([1, 7, 1], [1.0, 5.0, 2.0]), ([], [])], "indices array<int>, values array<double>")
    assert [r.features for r in sparse_to_dense(twice, 3).collect()] == [[0.0, 3.0, 0.0], [0.0, 0.0, 0.0]]


def test_text_forms(spark):
    df = spark.createDataFrame([([5, 3, 3], [0.0, 1.5, 2.0])], "indices array<int>, values array<double>")
    assert df.select(sparse_to_text().alias("t")).head().t == "5:0 3:1.5 3:2"
    values = [0.1, 1.0, 1e-5, 1e22, 0.30000000000000004, 123456789.125]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", format_value(F.col("v")).alias("exact"), format_value_16g(F.col("v")).alias("short")
    ).collect()
    assert all(float(r.exact) == r.v for r in rows)
    assert [r.short for r in rows] == ["%.16g" % v for v in values]


def test_triples_with_and_without_rows(spark):
    triples = spark.createDataFrame([(0, 3, 1.5), (0, 3, 2.0), (2, 1, 4.0), (0, 1, 0.0)], "row_id bigint, col int, value double")
    rows = spark.createDataFrame([(0,), (1,), (2,)], "row_id bigint")
    got = {r.row_id: (r.indices, r["values"]) for r in from_triples(triples, rows).collect()}
    assert got == {0: ([1, 3, 3], [0.0, 1.5, 2.0]), 1: ([], []), 2: ([1], [4.0])}
    assert from_triples(triples).count() == 2


def test_csv_and_materialize(spark, tmp_path):
    path = write_file(tmp_path, "a.csv", "id|y|a|b\n7|3|1.5|x\n8|1|2.5|y\n")
    rows = read_csv_features(spark, path, "id bigint, y int, a double, b string", "y", "|", ignore=["b"], id="id", label_offset=-1)
    assert rows.columns == ["row_id", "label", "a"]
    assert sorted(tuple(r) for r in rows.collect()) == [(7, 2, 1.5), (8, 0, 2.5)]
    target = scratch_path(spark, "f")
    materialize_features(rows, target)
    with pytest.warns(UserWarning, match="overwritten"):
        assert materialize_features(rows.limit(1), target).count() == 1


@pytest.mark.parametrize("limit", [10, 0])
def test_vocabulary_both_ways(spark, limit):
    train = spark.createDataFrame([(0, [9, 2], [1.0, 2.0]), (1, [2], [3.0])], "row_id bigint, indices array<int>, values array<double>")
    other = spark.createDataFrame([(5, [1, 2, 9, 12], [1.0, 2.0, 3.0, 4.0]), (6, [1], [1.0]), (7, [], [])], train.schema)
    vocabulary = feature_vocabulary(train)
    assert sorted(tuple(r) for r in vocabulary.collect()) == [(2, 0), (9, 1)]
    got = {r.row_id: (r.indices, r["values"]) for r in apply_vocabulary(other, vocabulary, limit).collect()}
    assert got == {5: ([0, 1], [2.0, 3.0]), 6: ([], []), 7: ([], [])}
    same = spark.createDataFrame([(1, [9, 2, 9], [1.0, 2.0, 0.5])] * 2, train.schema)
    assert [(r.indices, r["values"]) for r in apply_vocabulary(same, vocabulary, limit).collect()] == [([0, 1, 1], [2.0, 0.5, 1.0])] * 2


def test_labels_are_kept_or_refused(spark, tmp_path):
    path = write_file(tmp_path, "a.svm", "2.7 0:1\n-1 1:2\n \t \n3\n")
    assert [r.label for r in read_svmlight(spark, path, label_type="double").orderBy("row_id").collect()] == [2.7, -1.0, 3.0]
    with pytest.raises(Exception, match="label 2.7"):
        read_svmlight(spark, path).collect()
    rows = with_targets(read_svmlight(spark, path, label_type="double"))
    assert sorted(r.targets for r in rows.collect()) == [[-1.0], [2.7], [3.0]]
    table = spark.createDataFrame([(1, 0.5, 2.0)], "id bigint, y double, a double")
    assert from_dense(table, ["a"], "id", "y", "double").head().label == 0.5
    with pytest.raises(Exception, match="label 0.5"):
        from_dense(table, ["a"], "id", "y").collect()
    csv = write_file(tmp_path, "c.csv", "y,a\n1.5,2\n")
    assert read_csv_features(spark, csv, "y double, a double", "y", label_type="double").head().label == 1.5


def test_scores(spark):
    long = spark.createDataFrame([(1, 1, 0.7), (0, 2, 0.5), (0, 0, 0.5)], "row_id bigint, cat int, prob double")
    assert {r.row_id: r.scores for r in scatter_scores(long, 3).collect()} == {0: [0.5, 0.0, 0.5], 1: [0.0, 0.7, 0.0]}
    best = {(r.row_id, r.cat) for r in best_n(long, 1).collect()}
    assert best == {(0, 0), (1, 1)} and best_n(long, -1).count() == 3
    rows = spark.createDataFrame([(0,), (5,)], "row_id bigint")
    assert {r.row_id: r.scores for r in scatter_scores(long, 3, rows).collect()}[5] == [0.0, 0.0, 0.0]
    dense = spark.createDataFrame([(0, [0.2, 0.5, 0.5]), (1, [1.0, 0.0, 0.0])], "row_id bigint, scores array<double>")
    for n in (1, 2, -1):
        assert sorted(map(tuple, best_n_scores(dense, n).collect())) == sorted(map(tuple, best_n(long_scores(dense), n).collect()))
    with pytest.raises(Exception, match="repeated"):
        scatter_scores(long.union(long), 3).collect()
    rows = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.0, 0.0, 0.0],), ([0.1, 0.2, 0.7],)], "scores array<double>")
    assert [r.p for r in rows.select(predicted_class("scores").alias("p")).collect()] == [0, 0, 2]


def test_class_weight_length(spark):
    with pytest.raises(ValueError):
        class_weight(F.lit(0), [1.0], 2)


def test_run_logs(spark, tmp_path):
    write_file(tmp_path, "run-0001.txt", "a\nb\n")
    write_file(tmp_path, "run-0002.txt", "c\n")
    write_file(tmp_path, "other.txt", "z\n")
    write_file(tmp_path, "skip.log", "no\n")
    write_file(tmp_path, "run-10.txt", "e\n")
    write_file(tmp_path, "run-9.txt", "d\n")
    rows = read_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN).orderBy("log", "line_no").collect()
    assert [(r.log, r.line_no, r.value) for r in rows] == [("other", 0, "z"), *[("run", i, v) for i, v in enumerate("abcde")]]
    each = {(r.log.rsplit("/", 1)[1], r.line_no, r.value) for r in read_run_logs(spark, str(tmp_path)).collect()}
    assert each == {("run-0001.txt", 0, "a"), ("run-0001.txt", 1, "b"), ("run-0002.txt", 0, "c"), ("other.txt", 0, "z"),
                    ("run-9.txt", 0, "d"), ("run-10.txt", 0, "e")}
    assert read_run_logs(spark, str(tmp_path / "other.txt")).count() == 1
    assert read_run_logs(spark, str(tmp_path / "skip.log")).head().value == "no"
    (tmp_path / "deep").mkdir()
    write_file(tmp_path / "deep", "logs.json", "x\ny\n")
    assert read_run_logs(spark, str(tmp_path / "deep")).count() == 2
    names = spark.createDataFrame([("/x/my-run-12.txt",), ("/x/plain.txt",)], "p string").select(log_name(F.col("p"), ROLLED_FILE_PATTERN).alias("n"))
    assert [r.n for r in names.collect()] == ["my-run", "plain"]


def test_run_logs_of_folders_below_and_later_batches(spark, tmp_path):
    """Logs that tasks write themselves come back whole and in order, also those of a second batch in the same folder."""
    from workbook.inputs import LOG_FOLDER_PATTERN, in_line_order, write_logs

    lines = spark.range(400).select((F.col("id") % 3).cast("string").alias("log"), F.col("id").alias("line_no"), F.format_string("é %d", "id").alias("value"))
    path = str(tmp_path / "logs")
    write_logs(in_line_order(lines.where("line_no < 250")), path)
    write_logs(in_line_order(lines.where("line_no >= 250")), path, 1)
    got = read_run_logs(spark, path, LOG_FOLDER_PATTERN).orderBy("log", "line_no").collect()
    want = [(str(log), n, f"é {i}") for log in range(3) for n, i in enumerate(range(log, 400, 3))]
    assert [(r.log, r.line_no, r.value) for r in got] == want


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    from gradloom.sources.journals import LOOKED_AT, log_glob

    for i in range(LOOKED_AT + 20):
        (tmp_path / f"{i}.json").write_text("{}\n")
    assert log_glob(spark, str(tmp_path)) is None
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "a.txt").write_text("1\n")
    assert log_glob(spark, str(tmp_path)) is None
    (tmp_path / "z.txt").write_text("1\n")
    assert log_glob(spark, str(tmp_path)) == "*.txt"
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) < 10_000
