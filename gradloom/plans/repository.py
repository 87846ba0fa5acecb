"""Snapshots, training logs and registrations as tables in a run folder."""

from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.session import local_table

# Values of one array kept in one row of a snapshot.
ROW_VALUES = 1_000_000

SNAPSHOT_SCHEMA = "run string, iteration bigint, name string, shape array<int>, chunk int, values array<double>"
LOG_SCHEMA = "log string, iteration double, split string, metric string, value double"
RUN_SCHEMA = "run string, number int, prefix string"
# Run of snapshots that no fit wrote.
GIVEN = "given"


class RunFolder:
    """``<path>/runs``, ``<path>/snapshots/<run>/iter_…``, ``<path>/log``, ``<path>/calls``.

    Every fit is a run with a name of its own in the folder, and every snapshot and log row names its run. The latest
    snapshot is the last one of the newest run that has any; a resumed fit goes on in that run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def start_run(self, name: str, prefix: str | None = None) -> str:
        """Register a new run, ``<name>_<number>``; numbers count the runs of the folder.

        Folders of its snapshots begin with ``prefix``.
        """
        number = 1 + max((r["number"] for r in self._runs()), default=0)
        run = f"{name or 'run'}_{number}"
        local_table(self.spark, [(run, number, prefix or "")], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/runs")
        return run

    def _runs(self) -> list:
        try:
            return self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.path}/runs").collect()  # one row per fit
        except AnalysisException:
            return []

    def save_snapshot(self, iteration: int, arrays: dict[str, np.ndarray], run: str = GIVEN) -> None:
        """Write, or replace, the snapshot of an iteration; Spark commits it as a whole."""
        rows = []
        for name, array in arrays.items():
            flat = np.asarray(array, dtype=np.float64).ravel()
            pieces = range(0, max(len(flat), 1), ROW_VALUES)
            rows += [
                (run, int(iteration), name, list(np.shape(array)), i, flat[at : at + ROW_VALUES].tolist())
                for i, at in enumerate(pieces)
            ]
        table = local_table(self.spark, rows, SNAPSHOT_SCHEMA).coalesce(1)  # model-sized
        table.write.mode("overwrite").parquet(self.snapshot_path(iteration, run))

    def snapshot_path(self, iteration: int, run: str = GIVEN) -> str:
        prefix = next((r["prefix"] for r in self._runs() if r["run"] == run), "")
        return f"{self.path}/snapshots/{run}/{prefix}iter_{iteration:09d}"

    def snapshots(self) -> DataFrame:
        """All snapshots: ``run``, ``iteration``, ``name``, ``shape``, ``chunk``, ``values``."""
        return self.spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{self.path}/snapshots/*/*")

    def latest(self) -> tuple[str, int] | None:
        """Run and iteration of the latest snapshot."""
        try:
            last = self.snapshots().groupBy("run").agg(F.max("iteration").alias("iteration")).collect()  # one row per run
        except AnalysisException:
            return None
        numbers = {r["run"]: r["number"] for r in self._runs()}
        newest = max(last, key=lambda r: numbers.get(r["run"], 0), default=None)
        return None if newest is None else (newest["run"], newest["iteration"])

    def latest_iteration(self) -> int | None:
        latest = self.latest()
        return None if latest is None else latest[1]

    def append_log(self, rows: list[tuple]) -> None:
        """Add (log, iteration, split, metric, value) rows; nothing is written when there are none."""
        if rows:
            local_table(self.spark, rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log")

    def append_call(self, kind: str, settings) -> None:
        """One JSON line per submitted fit or prediction."""
        body = json.dumps({"kind": kind, "settings": settings if isinstance(settings, dict) else asdict(settings)})
        local_table(self.spark, [(body,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/calls")

    def calls(self) -> DataFrame:
        return self.spark.read.json(f"{self.path}/calls")


def latest_path(folder: RunFolder) -> str:
    latest = folder.latest()
    if latest is None:
        raise ValueError(f"{folder.path} holds no snapshot")
    return folder.snapshot_path(latest[1], latest[0])


def load_arrays(spark: SparkSession, path: str) -> dict[str, np.ndarray]:
    pieces: dict[str, list] = {}
    for row in spark.read.schema(SNAPSHOT_SCHEMA).parquet(path).orderBy("name", "chunk").collect():  # model-sized
        pieces.setdefault(row["name"], [tuple(row["shape"])]).append(row["values"])
    return {name: np.concatenate(chunks).reshape(shape) for name, (shape, *chunks) in pieces.items()}
