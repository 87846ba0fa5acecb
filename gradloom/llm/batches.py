"""Arrow maps over texts in batches of bounded bytes."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame

from gradloom import session

# Bytes of one Arrow batch (or one row): rows of texts differ too much in length for a number of rows to bound memory.
BATCH_BYTES = 8 * 1024 * 1024
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """The same table; Arrow batches of its session hold ``BATCH_BYTES`` at most. A smaller setting stays."""
    conf = df.sparkSession.conf
    held = conf.get(BATCH_CONF).removesuffix("b")
    if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front as long as the table has such a column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def map_arrow(df: DataFrame, kernel, schema) -> DataFrame:
    """``gradloom.session.map_arrow`` in ``bounded_batches``.

    Python workers serve many tasks, so each task gives the memory it freed back to the system when it ends.
    """

    def run(batches):
        try:
            yield from kernel(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim is not None:
                trim(0)

    return session.map_arrow(bounded_batches(df), run, schema)
