import os
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradloom.functions.logs import ROLLED_FILE_PATTERN
from gradloom.operators import runlog
from gradloom.session import scratch_path
from gradloom.sources.journals import read_run_logs
from gradloom.streaming import runlogs
from gradloom.streaming.runlogs import FOLLOWED, drain, follow, follow_in_batches, stream_run_logs


def put(folder, name, iterations):
    text = "".join(f"{{'iteration': {i}, 'mcll': 1.5}}\n" if i is not None else "noise\n" for i in iterations)
    (folder / name).write_text(text)


@pytest.mark.parametrize("way", ["state", "batches"])
def test_follow_equals_batch_over_restarts(spark, tmp_path, way):
    folder, sink, progress = tmp_path, scratch_path(spark, "sink"), scratch_path(spark, "progress")

    def go_on():
        lines = stream_run_logs(spark, str(folder), ROLLED_FILE_PATTERN)
        if way == "batches":
            return follow_in_batches(lines, sink)
        drain(follow(lines), sink, progress)
        return spark.read.schema(FOLLOWED).parquet(sink)

    put(folder, "a-0001.txt", [1, 2, None, 2])
    put(folder, "b-0001.txt", [5, 0])
    go_on()
    put(folder, "a-0002.txt", [1, 3])
    put(folder, "a-0003.txt", [2, "NaN", 10, 4])
    put(folder, "c-0001.txt", [7])
    go_on()
    got = sorted((r.log, r.iteration) for r in go_on().collect())
    batch = runlog.monotonic_filter(runlog.drop_bad_lines(runlog.parse_lines(read_run_logs(spark, str(folder), ROLLED_FILE_PATTERN))))
    assert got == sorted((r.log, r.iteration) for r in batch.collect())
    assert got == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), ("b", 5.0), ("c", 7.0)]


def test_streamed_lines_are_numbered(spark, tmp_path):
    put(tmp_path, "a-0001.txt", [1, None, 2])
    sink = scratch_path(spark, "sink")
    drain(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN), sink, scratch_path(spark, "progress"))
    rows = spark.read.schema("log string, file_path string, line_no int, value string").parquet(sink).orderBy("line_no")
    assert [(r.log, r.line_no) for r in rows.collect()] == [("a", 0), ("a", 1), ("a", 2)]
    assert rows.collect()[1].value == "noise"


def test_log_in_many_files_of_one_trigger(spark, tmp_path):
    """One log over forty files against a sequential pass, in small triggers and in one."""
    rng = random.Random(2)
    values = [[rng.randint(1, 400) + 5 * i for _ in range(20)] for i in range(40)]
    for i, part in enumerate(values):
        put(tmp_path, f"hot-{i:04d}.txt", part)
        os.utime(tmp_path / f"hot-{i:04d}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    top, expected = 0, []
    for v in (v for part in values for v in part):
        if v > top:
            top = v
            expected.append(float(v))
    for files in (None, 7):
        kept = follow_in_batches(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN, files_per_trigger=files), scratch_path(spark, "s"))
        assert sorted(r.iteration for r in kept.collect()) == expected


def rising(values, top=0):
    out = []
    for v in values:
        if v > top:
            top = v
            out.append(float(v))
    return out


def test_a_long_file_is_followed_by_its_splits(spark, tmp_path, monkeypatch):
    """One log of many splits in one trigger, with more lines than its task holds; a second trigger goes on from the first."""
    monkeypatch.setattr(runlogs, "HELD_LINES", 40)
    monkeypatch.setattr(runlogs, "SEGMENT_LINES", 25)
    rng = random.Random(3)
    values = [rng.randint(1, 300) + i for i in range(3000)]
    put(tmp_path, "hot-0002.txt", values[:2000])
    put(tmp_path, "hot-0010.txt", values[2000:2600])
    (tmp_path / "empty-0001.txt").write_text("")
    sink, progress = scratch_path(spark, "sink"), scratch_path(spark, "progress")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        raw = scratch_path(spark, "raw")
        drain(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN), raw, scratch_path(spark, "progress"))
        rows = spark.read.schema("log string, file_path string, block bigint, line_no int, value string").parquet(raw)
        assert rows.select("block").distinct().count() > 5
        lines = [r.value for r in rows.orderBy("file_path", "block", "line_no").collect()]
        assert lines == [f"{{'iteration': {v}, 'mcll': 1.5}}" for v in values[:2600]]
        drain(follow(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN)), sink, progress)
        put(tmp_path, "hot-0011.txt", values[2600:])
        drain(follow(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN)), sink, progress)
        shared = follow_in_batches(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN), scratch_path(spark, "s"))
        assert sorted(r.iteration for r in shared.collect()) == rising(values)
    finally:
        for conf in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{conf}")
    assert sorted(r.iteration for r in spark.read.schema(FOLLOWED).parquet(sink).collect()) == rising(values)


def test_outdone_lines_stay_behind_where_they_are_read():
    rng = random.Random(4)
    for _ in range(30):
        n = rng.randint(0, 60)
        place = [(rng.choice("ab"), rng.choice("xy"), rng.choice([0, 64]), i) for i in range(n)]
        rng.shuffle(place)
        value = [float(rng.randint(-3, 9)) for _ in range(n)]
        names = ["log", "file_path", "block", "line_no"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int32()]
        columns = [pa.array([p[i] for p in place], k) for i, k in enumerate(kinds)]
        batch = pa.RecordBatch.from_arrays([*columns, pa.array(value, pa.float64())], names=[*names, "iteration"])
        (kept,) = runlogs.rising_in_place([batch])
        want = [(*p, v) for p, v in zip(place, value) if all(w < v for q, w in zip(place, value) if q[:2] == p[:2] and q[2:] < p[2:])]
        assert [tuple(r.values()) for r in kept.to_pylist()] == want


def test_idle_logs_end_once(spark, tmp_path):
    put(tmp_path, "a-0001.txt", [1, 2])
    put(tmp_path, "b-0001.txt", [1])
    query = (
        follow(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN), timeout=2.0)
        .writeStream.format("memory").queryName("ended_runs").outputMode("append")
        .option("checkpointLocation", scratch_path(spark, "progress")).trigger(processingTime="1 second").start()
    )
    try:
        deadline = time.time() + 90
        while time.time() < deadline and spark.table("ended_runs").where("ended").count() < 2:
            time.sleep(1)
        rows = spark.table("ended_runs")
        assert sorted(r.log for r in rows.where("ended").collect()) == ["a", "b"]
        assert rows.where(~F.col("ended")).count() == 3
    finally:
        query.stop()


def test_growing_files_are_followed(spark, tmp_path, monkeypatch):
    """Files that grow between triggers, in the middle of a line too, give each line once, whatever the ranges."""
    from gradloom.streaming import growing

    monkeypatch.setattr(growing, "RANGE_BYTES", 7)
    monkeypatch.setattr(growing, "LOOK_BACK_BYTES", 5)
    (tmp_path / "in").mkdir()
    sink, progress = scratch_path(spark, "sink"), scratch_path(spark, "progress")
    lines = "log string, file_path string, line_no bigint, value string"
    steps = [
        {"x-1.txt": "first\nsecond line, longer than a range\nthi", "x-2.txt": ""},
        {"x-1.txt": "rd\n\n", "x-2.txt": "été\nopen"},
        {"x-2.txt": " end\n", "x-3.txt": "new\n"},
    ]
    for step in steps:
        for name, text in step.items():
            with (tmp_path / "in" / name).open("a") as file:
                file.write(text)
        drain(growing.stream_growing_logs(spark, str(tmp_path / "in")), sink, progress)
    found = {}
    for r in spark.read.schema(lines).parquet(sink).orderBy("line_no").collect():
        found.setdefault(r.log.rsplit("/", 1)[1], []).append(r.value)
    assert found == {
        "x-1.txt": ["first", "second line, longer than a range", "third", ""], "x-2.txt": ["été", "open end"], "x-3.txt": ["new"],
    }


def test_growing_log_is_filtered_as_it_grows(spark, tmp_path):
    from gradloom.streaming.growing import stream_growing_logs

    sink, progress, file = scratch_path(spark, "sink"), scratch_path(spark, "progress"), tmp_path / "logs.json"
    for part in ([1, 2, None], [2, 3], [1, 9]):
        with file.open("a") as out:
            out.write("".join(f"{{'iteration': {i}, 'mcll': 1.5}}\n" if i is not None else "noise\n" for i in part))
        drain(follow(stream_growing_logs(spark, str(file))), sink, progress)
    assert sorted(r.iteration for r in spark.read.schema(FOLLOWED).parquet(sink).collect()) == [1.0, 2.0, 3.0, 9.0]


def test_short_growing_files_share_a_task(tmp_path, monkeypatch):
    from gradloom.streaming import growing

    monkeypatch.setattr(growing, "RANGE_BYTES", 400)
    monkeypatch.setattr(growing, "OPEN_BYTES", 30)
    for i in range(50):
        (tmp_path / f"log-{i:02d}.txt").write_text(f"line {i}\n")
    (tmp_path / "long-1.txt").write_text("word\n" * 300)
    reader = growing.growing_source()({"path": str(tmp_path)}).streamReader(None)
    parts = reader.partitions({}, reader.latestOffset())
    assert len(parts) < 12
    assert all(sum(r.high - r.low for r in p.ranges) <= 400 for p in parts)
    values = [row[3] for p in parts for row in reader.read(p)]
    assert values == [f"line {i}" for i in range(50)] + ["word"] * 300


def test_small_files_of_a_trigger_share_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runlogs, "TASKS_PER_CORE", 1)
    for i in range(120):
        put(tmp_path, f"log{i}-0001.txt", [1, i % 5, 3])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        raw = scratch_path(spark, "raw")
        drain(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN), raw, scratch_path(spark, "progress"))
        assert len([f for f in os.listdir(raw) if f.endswith(".parquet")]) <= spark.sparkContext.defaultParallelism
        assert spark.read.parquet(raw).count() == 360
    finally:
        for conf in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{conf}")


@pytest.mark.parametrize("held", [5, 100_000])
def test_logs_that_share_a_key_are_told_apart(spark, tmp_path, monkeypatch, held):
    monkeypatch.setattr(runlogs, "LOG_BUCKETS", 2)
    monkeypatch.setattr(runlogs, "HELD_LINES", held)
    rng = random.Random(5)
    sink, progress, values = scratch_path(spark, "sink"), scratch_path(spark, "progress"), {}
    for roll in (9, 10):
        for i in range(12):
            part = [rng.randint(1, 20) + roll for _ in range(6)]
            values.setdefault(f"log{i}x", []).extend(part)
            put(tmp_path, f"log{i}x-{roll}.txt", part)
        drain(follow(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN)), sink, progress)
    got = {}
    for r in spark.read.schema(FOLLOWED).parquet(sink).orderBy("log", "iteration").collect():
        got.setdefault(r.log, []).append(r.iteration)
    assert got == {log: rising(part) for log, part in values.items()}


def test_lines_that_cannot_pass_leave_before_a_trigger_keeps_them(spark, tmp_path, monkeypatch):
    """Of each file only lines that rise in it go on to be cached, exchanged and joined, and the result is the same."""
    rng = random.Random(6)
    values = {f"log{i}-{roll}.txt": [rng.randint(1, 50) + 10 * roll for _ in range(80)] for i in range(5) for roll in (8, 9, 10)}
    for name, part in values.items():
        put(tmp_path, name, part)
    gone_on, whole = [], runlogs.earlier_max

    def counted(lines, *rest):
        gone_on.append(lines.count())
        return whole(lines, *rest)

    monkeypatch.setattr(runlogs, "earlier_max", counted)
    kept = follow_in_batches(stream_run_logs(spark, str(tmp_path), ROLLED_FILE_PATTERN), scratch_path(spark, "s"))
    got = {}
    for r in kept.orderBy("log", "iteration").collect():
        got.setdefault(r.log, []).append(r.iteration)
    assert got == {f"log{i}": rising([v for roll in (8, 9, 10) for v in values[f"log{i}-{roll}.txt"]]) for i in range(5)}
    assert gone_on == [sum(len(rising(part)) for part in values.values())]


def test_local_files_give_the_lines_of_the_text_reader(spark, tmp_path):
    texts = {
        "a b%20#é-1.txt": b"\xef\xbb\xbfone\r\n\n\xefnot utf-8\xff\nopen end", "b-1.txt": b"\n\n", "c-1.txt": b"", "d-1.txt": b"x\n",
        "e-1.txt": b"".join(b"w" * (i % 40) + b"\n" for i in range(300)),
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
    want = spark.read.option("lineSep", "\n").text(str(tmp_path)).select(F.col("_metadata.file_path").alias("file"), F.hex("value").alias("v"))
    want = sorted((r.file, r.v) for r in want.collect())
    for most in ("64", "128MB"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            raw = scratch_path(spark, "raw")
            drain(stream_run_logs(spark, str(tmp_path)).withColumn("v", F.hex("value")), raw, scratch_path(spark, "progress"))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        rows = spark.read.parquet(raw).orderBy("file_path", "block", "line_no").collect()
        assert sorted((r.file_path, r.v) for r in rows) == want
        assert all(r.log == r.file_path for r in rows)
        long = [bytes.fromhex(r.v) for r in rows if r.file_path.endswith("e-1.txt")]
        assert long == texts["e-1.txt"].split(b"\n")[:-1]
        places = [(r.file_path, r.block, r.line_no) for r in rows]
        assert len(set(places)) == len(places)


def test_splits_of_a_file_hold_each_line_once(tmp_path):
    rng = random.Random(7)
    for _ in range(60):
        text = bytes(rng.choice(b"ab\n") for _ in range(rng.randint(0, 60)))
        (tmp_path / "x.txt").write_bytes(text)
        step = rng.randint(1, 12)
        got = [runlogs.lines_between(str(tmp_path / "x.txt"), at, min(at + step, len(text))) for at in range(0, max(len(text), 1), step)]
        want = text.split(b"\n")
        assert [line for part in got for line in part] == (want if want[-1] else want[:-1])
