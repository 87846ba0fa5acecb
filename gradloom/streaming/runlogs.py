"""Following training logs while they are written."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gradloom.functions.logs import LINE_SCHEMA, log_name, roll_number
from gradloom.operators.ordering import earlier_max
from gradloom.operators.runlog import drop_bad_lines, parse_lines
from gradloom.session import attach, local_table, map_arrow, on_local_disk
from gradloom.sources.journals import log_glob

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Lines of a log's share of a trigger that its task holds in memory; the others wait in the state store, in segments of
# so many line numbers, and come back one segment at a time.
HELD_LINES, SEGMENT_LINES = 100_000, 50_000
# Tasks per core that read a trigger's files; each takes many small ones, or the splits of a long one, in turn.
TASKS_PER_CORE = 8
# Keys that logs without timers share.
LOG_BUCKETS = 1024
# Bytes of a local file that one task reads at a time; a longer file is read by several tasks.
SPLIT_BYTES = 16 * 1024 * 1024
# Lines and bytes that leave a reading task together.
BATCH_LINES, BATCH_BYTES = 10_000, 8 * 1024 * 1024
# What orders the lines of a file.
PLACE = ["file_path", "block", "line_no"]

# What Spark's file source tells of files whose content is not asked for, and the lines of ``stream_run_logs``.
FILES = "path string, modificationTime timestamp, length bigint, content binary"
STREAMED = "log string, file_path string, block bigint, line_no int, value string"
FOLLOWED = T.StructType([T.StructField("log", T.StringType()), *LINE_SCHEMA, T.StructField("ended", T.BooleanType())])


def stream_run_logs(
    spark: SparkSession, path: str, pattern: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """``log``, ``file_path``, ``block``, ``line_no``, ``value`` of every line of new log files under ``path``.

    A file is a log, named by its path, unless ``pattern`` takes the log from the path. Writers that roll files then
    number their names; a file is read in one trigger, by as many tasks as it has splits, and the files of one trigger
    follow each other by those numbers. ``block`` is the byte at which a line's split begins, and ``line_no`` its place in the
    split: in the file, if that has one split only. With ``files_per_trigger`` the source hands files out in order of their
    modification time, so a log's files must then have been finished one after the other. Empty files have no lines.

    Spark's text reader takes some 2.6 ms to open a file, for a short log more than all the rest. On a local file system Spark
    therefore finds the files only, and tasks read them themselves; from other stores lines come through that reader.
    """
    reader = spark.readStream.option("recursiveFileLookup", True)
    glob = log_glob(spark, path)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    file, block = F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block")
    log = log_name(F.col("file_path"), pattern).alias("log")
    # Small files come a few to a partition; a Python worker per partition would cost more than reading them.
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    lenient = any(spark.conf.get(f"spark.sql.files.ignore{kind}Files") == "true" for kind in ("Missing", "Corrupt"))
    if glob is not None and not lenient and on_local_disk(spark, path):  # files of other names may be compressed
        files = reader.format("binaryFile").schema(FILES).load(path).select(file, "path", "length").coalesce(tasks)
        most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        step = F.lit(min(SPLIT_BYTES, most)).cast("bigint")
        starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0).cast("bigint")), step)
        splits = files.select(log, "file_path", "path", "length", F.explode(starts).alias("block"))
        splits = splits.withColumn("end", F.least(F.col("block") + step, F.col("length"))).drop("length")
        return map_arrow(splits.repartition(tasks, "file_path", "block"), read_splits, STREAMED)
    lines = reader.option("lineSep", "\n").text(path).select(file, block, F.lit(0).alias("line_no"), "value")
    numbered = map_arrow(lines.coalesce(tasks), number_in_splits, lines.schema)
    return numbered.select(log, "file_path", "block", "line_no", "value")


def read_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that begin in each split, from byte ``block`` up to ``end`` of a local file, numbered in the split."""
    held, lines, size = [], 0, 0
    for batch in batches:
        for log, file, path, block, end in zip(*(batch.column(c).to_pylist() for c in ("log", "file_path", "path", "block", "end"))):
            found = lines_between(path.removeprefix("file:"), block, end)
            for at in range(0, len(found), BATCH_LINES):
                piece = found[at : at + BATCH_LINES]
                held.append((log, file, block, at, piece))
                lines, size = lines + len(piece), size + sum(map(len, piece))
                if lines >= BATCH_LINES or size >= BATCH_BYTES:
                    yield _as_batch(held)
                    held, lines, size = [], 0, 0
    if held:
        yield _as_batch(held)


def lines_between(path: str, low: int, high: int) -> list[bytes]:
    """Whole lines that begin at bytes ``low`` to ``high`` - 1, as Spark's reader gives them with ``lineSep`` as a newline."""
    with open(path, "rb") as file:
        if low > 0:  # a line begins behind a newline, which may be the last byte of the split before
            file.seek(low - 1)
            data = file.read(high - low + 1)
            cut = data.find(b"\n", 0, high - low)
            if cut < 0:
                return []
            data = data[cut + 1 :]
        else:
            data = file.read(high).removeprefix(b"\xef\xbb\xbf")
        parts = [data]
        while parts[-1] and not parts[-1].endswith(b"\n"):  # the end of the last line
            more = file.read(64 * 1024)
            parts.append(more[: more.find(b"\n") + 1] or more)
    lines = b"".join(parts).split(b"\n")
    return lines if lines[-1] else lines[:-1]


def _as_batch(held: list[tuple]) -> pa.RecordBatch:
    logs, files, blocks, starts, pieces = zip(*held)
    counts = [len(piece) for piece in pieces]
    each = np.repeat(np.arange(len(held)), counts)
    first = np.repeat(np.array(starts) - np.r_[0, np.cumsum(counts)[:-1]], counts)
    values = pa.array([line for piece in pieces for line in piece], pa.binary()).view(pa.string())  # not checked, as in Spark
    columns = [pa.array(logs, pa.string()).take(pa.array(each)), pa.array(files, pa.string()).take(pa.array(each))]
    columns += [pa.array(np.repeat(np.array(blocks, np.int64), counts)), pa.array((first + np.arange(len(each))).astype(np.int32)), values]
    return pa.RecordBatch.from_arrays(columns, names=["log", "file_path", "block", "line_no", "value"])


def number_in_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``line_no`` as the place of a line in its split; a task reads split after split, each from its start."""
    split, place = None, 0
    for batch in batches:
        files, blocks = batch.column("file_path"), batch.column("block").to_numpy()
        fresh = np.r_[True, blocks[1:] != blocks[:-1]]
        if batch.num_rows > 1:
            fresh[1:] |= pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(fresh)
        at = np.arange(batch.num_rows) - np.repeat(starts, np.diff(np.r_[starts, batch.num_rows]))
        for n, start in enumerate(starts.tolist()):
            named = (files[start].as_py(), int(blocks[start]))
            end = starts[n + 1] if n + 1 < len(starts) else batch.num_rows
            if named == split:
                at[start:end] += place
            split, place = named, int(at[end - 1]) + 1
        yield batch.set_column(batch.schema.get_field_index("line_no"), "line_no", pa.array(at, pa.int32()))


def rising_in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leave out lines with an earlier line of their file in the same batch that has their iteration or more.

    Such lines never pass ``rising_iterations``, and the first line of a file always stays, so timers see every file.
    """
    for batch in batches:
        # Numbers for the names: files need to lie apart, in whatever order.
        log, file = (_codes(batch.column(c)) for c in ("log", "file_path"))
        block, line = (batch.column(c).to_numpy() for c in PLACE[1:])
        order = np.lexsort((line, block, file, log))
        log, file = log[order], file[order]
        fresh = np.r_[True, (log[1:] != log[:-1]) | (file[1:] != file[:-1])][: len(order)]
        value = pd.Series(batch.column("iteration").to_numpy(zero_copy_only=False)[order])
        files = np.cumsum(fresh)
        before = value.groupby(files).cummax().groupby(files).shift()
        kept = order[(before.isna() | (value > before)).to_numpy()]
        yield batch.take(pa.array(np.sort(kept)))


def _codes(names: pa.Array) -> np.ndarray:
    """One number per distinct value, null included."""
    return pc.fill_null(names.dictionary_encode().indices, -1).to_numpy()


def rising_iterations(timeout_ms: int | None) -> StatefulProcessor:
    """The processor behind ``follow``; a local class, so that it travels by value to every kind of worker."""
    held_lines, segment_lines = HELD_LINES, SEGMENT_LINES
    place = ["log", "roll", "file_path", "block", "segment"]

    class RisingIterations(StatefulProcessor):
        """Per log, remembers the largest iteration seen and lets only larger ones pass.

        A key is one log, or a bucket of them. What a trigger brings of it is cut into segments that follow each log's order.
        Beyond ``HELD_LINES`` segments wait in the state store and are taken back one by one, so memory does not grow with
        the trigger. With a timeout, a processing-time timer is renewed by every batch of lines; when it fires the run is over.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.tops = handle.getMapState("tops", "log string", "iteration double")
            self.timer = handle.getValueState("timer", "at bigint")
            self.waiting = handle.getMapState("waiting", "piece bigint", "lines binary")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            if timeout_ms is not None:
                if self.timer.exists():
                    self.handle.deleteTimer(self.timer.get()[0])
                due = timerValues.getCurrentProcessingTimeInMs() + timeout_ms
                self.handle.registerTimer(due)
                self.timer.update((due,))
            self.stored = 0
            pieces, held = {}, []  # by place: numbers of stored pieces; frames in memory
            for frame in rows:
                held.append(frame.assign(segment=frame["line_no"] // segment_lines))
                if sum(map(len, held)) > held_lines:
                    self.put_aside(held, pieces)
                    held = []
            if not pieces:
                yield from self.risen(pd.concat(held))
                return
            if held:
                self.put_aside(held, pieces)
            for at in sorted(pieces):
                yield from self.risen(pd.concat([self.taken(p) for p in pieces.pop(at)]))

        def risen(self, lines: pd.DataFrame) -> Iterator[pd.DataFrame]:
            lines = lines.sort_values([*place, "line_no"], kind="stable")
            logs = lines["log"]
            found = {log: self.tops.getValue((log,)) for log in logs.unique()}
            floor = logs.map({log: 0.0 if top is None else top[0] for log, top in found.items()})
            before = lines["iteration"].groupby(logs, sort=False).cummax().groupby(logs, sort=False).shift()
            kept = lines[lines["iteration"] > np.fmax(before, floor)]
            if len(kept):
                for log, top in kept.drop_duplicates("log", keep="last")[["log", "iteration"]].itertuples(index=False):
                    self.tops.updateValue((log,), (float(top),))
                yield kept.assign(ended=False)[FOLLOWED.names]

        def put_aside(self, held: list[pd.DataFrame], pieces: dict) -> None:
            for at, piece in pd.concat(held).groupby(place, sort=False, dropna=False):
                table = pa.Table.from_pandas(piece, preserve_index=False)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as out:
                    out.write_table(table)
                self.waiting.updateValue((self.stored,), (sink.getvalue().to_pybytes(),))
                pieces.setdefault(at, []).append(self.stored)
                self.stored += 1

        def taken(self, piece: int) -> pd.DataFrame:
            raw = self.waiting.getValue((piece,))[0]
            self.waiting.removeKey((piece,))
            return pa.ipc.open_stream(raw).read_pandas()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.timer.clear()
            row = {name: None for name in LINE_SCHEMA.names}
            yield pd.DataFrame({"log": [key[0]], **{n: pd.Series([v], dtype="float64") for n, v in row.items()}, "ended": [True]})

        def close(self) -> None:
            pass

    return RisingIterations()


def _with_block(lines: DataFrame) -> DataFrame:
    """Lines of sources that number them along the whole file are of one block."""
    return lines if "block" in lines.columns else lines.withColumn("block", F.lit(0).cast("bigint"))


def follow(lines: DataFrame, timeout: float | None = None) -> DataFrame:
    """Accepted lines of streamed logs; with ``timeout`` (seconds, usually ``IDLE_SECONDS``) also an ``ended`` row per
    idle run.

    Tasks that read lines leave out those that an earlier line of their file outdoes (``rising_in_place``); one task per
    log orders the others, segment by segment. A call of the stateful processor costs far more than the lines of a short
    log, so logs share ``LOG_BUCKETS`` keys; with timers, which belong to a key, each is its own.
    ``follow_in_batches`` shares the work of one log too, and has no timers.
    """
    spark = lines.sparkSession
    attach(spark)
    if "RocksDB" not in spark.conf.get(STATE_STORE, ""):
        spark.conf.set(STATE_STORE, ROCKSDB)  # per-key state with timers needs this store
    wanted = drop_bad_lines(parse_lines(_with_block(lines))).withColumn("roll", roll_number(F.col("file_path")).cast("double"))
    bucket = F.pmod(F.xxhash64("log"), F.lit(LOG_BUCKETS)).cast("string")
    rising = map_arrow(wanted, rising_in_place, wanted.schema).withColumn("key", bucket if timeout is None else F.col("log"))
    return rising.groupBy("key").transformWithStateInPandas(
        statefulProcessor=rising_iterations(None if timeout is None else int(timeout * 1000)),
        outputStructType=FOLLOWED,
        outputMode="Append",
        timeMode="None" if timeout is None else "ProcessingTime",
    )


def follow_in_batches(lines: DataFrame, folder: str) -> DataFrame:
    """Process everything there is as ``follow`` does, however large a single log, and return all accepted lines.

    Every trigger is an ordinary batch: lines are filtered split by split with carried maxima, so a log of any
    length is shared by many tasks. The largest iteration per log is a table with one version per trigger; a
    trigger that is repeated after a failure reads the version before it and overwrites its own output. Call it
    again with the same ``folder`` (in shared storage) to go on where it ended.
    """
    spark = lines.sparkSession
    tops, kept = "log string, top double", T.StructType([f for f in FOLLOWED if f.name != "ended"])

    def version(number: int) -> DataFrame:
        if number < 0:
            return local_table(spark, [], tops)
        return spark.read.schema(tops).parquet(f"{folder}/tops/{number}")

    def one_trigger(batch: DataFrame, number: int) -> None:
        # Lines are needed for the maxima and again behind them; files are opened once. Of a file's lines only those stay
        # that no earlier one outdoes where they are read: they hold its maximum, and the others never pass.
        wanted = drop_bad_lines(parse_lines(_with_block(batch)))
        rising = map_arrow(wanted, rising_in_place, wanted.schema)
        fresh = rising.withColumn("roll", roll_number(F.col("file_path"))).persist(StorageLevel.MEMORY_AND_DISK)
        known = version(number - 1)
        place = F.struct("roll", "file_path", "block")
        seen = earlier_max(fresh, "log", ["line_no"], "iteration", place, "_seen")
        floor = F.coalesce(F.greatest("_seen", "top"), F.lit(0.0))
        passed = seen.join(known, "log", "left").where(F.col("iteration") > F.greatest(floor, F.lit(0.0)))
        passed.select(*kept.names).write.mode("overwrite").parquet(f"{folder}/kept/trigger={number}")
        fresh.unpersist()
        written = spark.read.schema(kept).parquet(f"{folder}/kept/trigger={number}")
        newest = written.groupBy("log").agg(F.max("iteration").alias("top")).unionByName(known)
        newest = newest.groupBy("log").agg(F.max("top").alias("top"))
        newest.write.mode("overwrite").parquet(f"{folder}/tops/{number}")

    query = (
        lines.writeStream.foreachBatch(one_trigger)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(kept).option("recursiveFileLookup", True).parquet(f"{folder}/kept")


def drain(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process everything there is and stop; run again with the same checkpoint to go on where it ended.

    State, source progress and sink commits live in the shared folder, so a lost executor or a restart neither
    repeats nor loses lines.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
