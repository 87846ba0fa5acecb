"""Inputs the queries share, as Spark tables and as SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.operators.metrics import with_prediction
from gradloom.operators.prepare import train_test_split
from gradloom.plans.solver import SolverConfig
from gradloom.plans.training import SoftmaxRegression
from gradloom.session import on_local_disk, scratch_path, spread
from gradloom.sources.tables import from_dense

SPLIT_SEED = 7
NCLASSES = 10
WIDTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table that takes work per row; a file of one row group would keep all of it in one task."""
    return spread(table(spark, sf_dir, name).select(*columns))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_dense(table(spark, sf_dir, "embeddings"), "embedding", "vec_id", "label")


def split_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test_split(vectors(spark, sf_dir), 0.2, SPLIT_SEED)


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_vectors(spark, sf_dir).where(F.col("split") == "train").drop("split")


def with_zeros(df: DataFrame, below: float) -> DataFrame:
    """Small values set to zero, so that sparse forms have something to leave out."""
    return df.withColumn("features", F.transform("features", lambda v: F.when(F.abs(v) < below, 0.0).otherwise(v)))


def in_id_order(df: DataFrame) -> DataFrame:
    """Rows whose written files follow the order of their ids."""
    return df.repartitionByRange("row_id").sortWithinPartitions("row_id")


def one_step_model(spark: SparkSession, sf_dir: str) -> SoftmaxRegression:
    """Softmax regression after one full-batch step from zero weights, on the training split."""
    model = SoftmaxRegression(NCLASSES)
    model.fit(training_rows(spark, sf_dir), solver=SolverConfig(iterations=1, base_lr=1.0), batch_size=None)
    return model


def one_step_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id``, ``label``, ``split``, ``scores``, ``pred`` of all vectors."""
    return with_prediction(one_step_model(spark, sf_dir).predict_proba(split_vectors(spark, sf_dir)))


# Which metric an event type stands for in the derived training logs.
EVENT_METRICS = {"click": "mcll", "view": "accp", "signup": "f1", "purchase": "train_loss", "error": "acc"}


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``as_log_lines`` makes lines of: events under the names ``log`` and ``line_no``, one log per user."""
    events = dealt_table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value", "props")
    return events.select(
        F.col("user_id").cast("string").alias("log"), F.col("event_id").alias("line_no"), "event_type", "value", "props"
    )


def as_log_lines(events: DataFrame) -> DataFrame:
    """Events as training-log lines; ``error`` events become cut-off lines."""
    names = F.create_map(*[F.lit(x) for pair in EVENT_METRICS.items() for x in pair])
    head = F.concat(
        F.lit("{'iteration': "), F.get_json_object("props", "$.k"), F.lit(", '"), F.element_at(names, F.col("event_type")), F.lit("': ")
    )
    line = F.when(F.col("event_type") == "error", head).otherwise(F.concat(head, F.col("value").cast("string"), F.lit("}")))
    return events.select("log", "line_no", line.alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as training-log lines, one log per user."""
    return as_log_lines(log_events(spark, sf_dir))


def in_line_order(lines: DataFrame) -> DataFrame:
    """Ranges of (log, line); their number is named, so that small data is still written by many tasks."""
    ranges = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartitionByRange(ranges, "log", "line_no").sortWithinPartitions("log", "line_no")


def written_logs(spark: SparkSession, sf_dir: str) -> str:
    """The log lines as text files, one per log and range; range partitions keep file order and split long logs."""
    path = scratch_path(spark, "logs")
    # Lines are made behind the exchange: finding its ranges goes over the rows two more times.
    write_logs(as_log_lines(in_line_order(log_events(spark, sf_dir))), path)
    return path


def write_logs(lines: DataFrame, path: str, batch: int = 0) -> None:
    """Sorted lines as text files, ``<range>/log=<log>-<range>.txt``, or ``log=<log>/part-….txt`` on remote stores.

    Files of a later ``batch`` follow those of earlier ones. Hadoop's local file system starts several processes for each file it creates, which for many small logs takes longer
    than all the rest, so tasks write local files themselves. A task renames its folder when it is done; where another
    attempt has done so before, that one's files stay.
    """
    spark = lines.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not on_local_disk(spark, path):
        lines.select("log", "value").write.mode("append").partitionBy("log").text(path)
        return
    folder = place.toUri().getPath()

    def write(batches):
        import os
        import uuid

        from pyspark import TaskContext

        number = f"{batch}{TaskContext.get().partitionId():06d}"
        attempt, done = f"{folder}.writing/{uuid.uuid4().hex}", f"{folder}/{number}"
        current, out, files = None, None, 0
        for rows in batches:
            logs, values = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("log", "value"))
            starts = [i for i in range(len(logs)) if i == 0 or logs[i] != logs[i - 1]]
            for start, end in zip(starts, [*starts[1:], len(logs)]):
                if out is None or logs[start] != current:
                    if out is None:
                        os.makedirs(attempt)
                    else:
                        out.close()
                    current, files = logs[start], files + 1
                    out = open(f"{attempt}/log={current}-{number}.txt", "wb")
                out.write("".join((v or "") + "\n" for v in values[start:end]).encode())
        if out is not None:
            out.close()
            os.makedirs(folder, exist_ok=True)
            try:
                os.rename(attempt, done)
            except OSError:
                if not os.path.isdir(done):
                    raise
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    lines.select("log", "value").mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


# Takes the log from the names of ``write_logs``.
LOG_FOLDER_PATTERN = r"log=([^/]+?)(?:-\d+\.txt|/[^/]*)$"


# -- SQL ------------------------------------------------------------------------------------------------------

def hash_sql(seed: int, column: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {column}), 1, 8) AS BIGINT) % 1000"


# One row per vector and feature; feature 64 is the constant 1 of the bias.
X_SQL = f"""
x AS (
  SELECT vec_id AS row_id, label,
         CASE WHEN {hash_sql(SPLIT_SEED, 'vec_id')} < 200 THEN 'test' ELSE 'train' END AS split,
         unnest(range({WIDTH + 1})) AS f, unnest(list_append(embedding::DOUBLE[], 1::DOUBLE)) AS v
  FROM embeddings),
tr AS (SELECT * FROM x WHERE split = 'train')"""

SPARSE_SQL = """
e AS (
  SELECT vec_id AS row_id, label, unnest(range(64)) AS i, unnest(embedding::DOUBLE[]) AS v FROM embeddings)"""

UPDATE_RULES = {
    # rule: (new first moment, new second moment, change), with g, m, s and the rate lr at hand
    "SGD": ("{mu} * m + {lr} * g", "s", "m1"),
    "NESTEROV": ("{mu} * m + {lr} * g", "s", "(1 + {mu}) * m1 - {mu} * m"),
    "ADAGRAD": ("m", "s + g * g", "{lr} * g / (sqrt(s1) + 1e-8)"),
    "RMSPROP": ("m", "0.99 * s + 0.01 * g * g", "{lr} * g / (sqrt(s1) + 1e-8)"),
    "ADADELTA": (
        "0.95 * m + 0.05 * pow(g * sqrt((m + 1e-8) / (0.95 * s + 0.05 * g * g + 1e-8)), 2)",
        "0.95 * s + 0.05 * g * g",
        "{lr} * g * sqrt((m + 1e-8) / (s1 + 1e-8))",
    ),
    "ADAM": (
        "0.9 * m + 0.1 * g",
        "0.999 * s + 0.001 * g * g",
        "{lr} * sqrt(1 - pow(0.999, {t})) / (1 - pow(0.9, {t})) * m1 / (sqrt(s1) + 1e-8)",
    ),
}


def softmax_chain(
    steps: int, rates=None, rule: str = "SGD", mu: float = 0.0, decay: float = 0.0, class_weights=None, tag: str = "",
    batches=None,
) -> str:
    """CTEs ``w<tag>0`` … ``w<tag><steps>``: the weights (f, k, w) after every step from zero, over all rows of ``tr`` or
    over the rows that ``batches`` (SQL with the step's number) names for each step."""
    rates = rates or [1.0] * steps
    cw = "1.0" if class_weights is None else f"{list(map(float, class_weights))}[label + 1]"
    first, second, change = UPDATE_RULES[rule]
    parts = [
        f"w{tag}0 AS (SELECT f, k, 0::DOUBLE AS w, 0::DOUBLE AS m, 0::DOUBLE AS s FROM range(65) a(f), range(10) b(k))"
    ]
    for t in range(steps):
        values = {"mu": mu, "lr": rates[t], "t": t + 1}
        rows = "tr" if batches is None else batches.format(t=t)
        parts.append(probabilities(f"p{tag}{t}", f"w{tag}{t}", rows))
        parts.append(
            f"g{tag}{t} AS (SELECT f, k, sum(v * (p - (label = k)::INT) * {cw}) / any_value(total) AS g "
            f"FROM {rows} JOIN (SELECT row_id, k, p FROM p{tag}{t}) q USING (row_id), "
            f"(SELECT sum({cw}) AS total FROM {rows} WHERE f = 64) n GROUP BY f, k)"
        )
        parts.append(
            f"u{tag}{t} AS (SELECT f, k, w, m, s, g + CASE WHEN f < 64 THEN {decay} * w ELSE 0 END AS g "
            f"FROM w{tag}{t} JOIN g{tag}{t} USING (f, k)), "
            f"v{tag}{t} AS (SELECT *, {first.format(**values)} AS m1, {second.format(**values)} AS s1 FROM u{tag}{t}), "
            f"w{tag}{t + 1} AS (SELECT f, k, w - ({change.format(**values)}) AS w, m1 AS m, s1 AS s FROM v{tag}{t})"
        )
    return ",\n".join(parts)


def probabilities(name: str, weights: str, rows: str) -> str:
    """CTE of class probabilities (row_id, label, split, k, p)."""
    return (
        f"{name} AS (SELECT row_id, label, split, k, exp(z) / sum(exp(z)) OVER (PARTITION BY row_id) AS p FROM "
        f"(SELECT row_id, label, split, k, sum(v * w) AS z FROM {rows} JOIN {weights} USING (f) "
        f"GROUP BY row_id, label, split, k))"
    )


def predictions(name: str, probs: str) -> str:
    return (
        f"{name} AS (SELECT row_id, label, split, k AS pred FROM {probs} "
        f"QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY p DESC, k) = 1)"
    )


def scored_sql(steps: int = 1) -> str:
    """WITH clause with ``prob`` (row_id, label, split, k, p) and ``pred`` of the one-step model."""
    return (
        f"WITH {X_SQL},\n{softmax_chain(steps)},\n{probabilities('prob', f'w{steps}', 'x')},\n{predictions('pred', 'prob')}"
    )


LINES_SQL = """
lines AS (
  SELECT user_id::VARCHAR AS log, event_id AS line_no, event_type, value,
         CAST(props->>'k' AS DOUBLE) AS iteration,
         CASE event_type WHEN 'click' THEN 'mcll' WHEN 'view' THEN 'accp' WHEN 'signup' THEN 'f1'
                         WHEN 'purchase' THEN 'train_loss' ELSE 'acc' END AS metric
  FROM events),
good AS (SELECT * FROM lines WHERE event_type <> 'error'),
kept AS (
  SELECT * FROM good
  QUALIFY iteration > greatest(0, coalesce(max(iteration) OVER (
    PARTITION BY log ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))"""
