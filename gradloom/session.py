"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Largest table (or model) the library ships to every executor. Anything beyond goes through a shuffle.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
# Smallest share of a cached table worth a partition of its own.
BALANCE_BYTES = 4 * 1024 * 1024
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def local_session(cpus: int | str = "*", app: str = "gradloom") -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    A machine-local folder is made only for local masters that name none.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def on_local_disk(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open files under ``path`` without Hadoop."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def list_in_few_tasks(spark: SparkSession) -> None:
    """Let few tasks list folders: by default each of up to 10,000 has a task, which costs more than listing them."""
    if int(spark.conf.get(LISTING_TASKS)) == 10_000:
        spark.conf.set(LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shipped_if_small(df: DataFrame, size: int) -> DataFrame:
    """Broadcast a side of a join whose bytes, counted before, are few; else it is shuffled."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def spread(df: DataFrame) -> DataFrame:
    """Deal a plain scan out over all cores if it comes in fewer partitions; larger tables stay as they are.

    For scans only: asking a table that needs a shuffle for its partitions would run that shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else _dealt(df, cores)


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    """By a hash of the row: the same deal on every retry, without the sort a round-robin needs for that."""
    return df.repartition(parts, F.xxhash64(*df.columns))


def persist_balanced(df: DataFrame, row_bytes: int | Column) -> tuple[DataFrame, int]:
    """Cache rows that are gone over many times; also the number of partitions that hold rows.

    A table of which few partitions hold rows (one large file block, say) is dealt out once, 4 MB or more per
    partition and at most one partition per core. Larger tables have more partitions than that already.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    size = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    held = cached.groupBy(F.spark_partition_id()).agg(F.sum(size.cast("bigint")).alias("bytes"))
    found = held.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count("*").alias("filled")).head()
    target = min(df.sparkSession.sparkContext.defaultParallelism, found["bytes"] // BALANCE_BYTES)
    if target <= max(found["filled"], 1):
        return cached, max(found["filled"], 1)
    dealt = _dealt(cached, target).persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()
    cached.unpersist()
    return dealt, target


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a table, without starting Python workers."""
    fields = T.StructType.fromDDL(schema)
    columns = [pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, names=fields.names), schema=fields)


def attach(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context (as ``--py-files`` would)."""
    context = spark.sparkContext
    if getattr(context, "_gradloom_sent", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "gradloom.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._gradloom_sent = True


def map_arrow(df: DataFrame, kernel, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the workers."""
    attach(df.sparkSession)
    return df.mapInArrow(kernel, schema)
