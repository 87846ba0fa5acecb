"""Training rows as blocks: one table row per Arrow batch, its columns as bytes, so that no pass handles single values in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gradloom.plans.cells import Binning, DenseCells, Layout, SparseCells, raw_cells, sparse_names
from gradloom.session import map_arrow

# Bytes of the rows that make a block; a batch that holds more is cut.
BLOCK_BYTES = 4 * 1024 * 1024


class Block:
    """One row of a table of blocks: ``rows`` and columns of bytes."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        self.batch, self.at = batch, at
        self.rows = batch.column("rows")[at].as_py()

    def values(self, name: str, kind=np.float64) -> np.ndarray:
        return np.frombuffer(self.batch.column(name)[self.at].as_buffer(), kind)

    def matrix(self, name: str) -> np.ndarray:
        """Some numbers per row, such as one per output."""
        return self.values(name).reshape(self.rows, -1)

    def items(self, name: str) -> pa.Array:
        """A column that is a list, one item per row."""
        return self.batch.column(name)[self.at].values

    def with_columns(self, kept: Iterable[str], **columns: np.ndarray) -> pa.RecordBatch:
        """A block with these columns of this one, and with new ones."""
        held = {c: self.batch.column(c).slice(self.at, 1) for c in kept}
        return pa.RecordBatch.from_pydict(held | {c: _blob(v) for c, v in columns.items()})


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield Block(batch, at)


def _blob(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


def _cell_columns(cells: DenseCells | SparseCells, binning: Binning | None) -> dict[str, np.ndarray]:
    """Cells as bytes: dense ones column by column, sparse ones with their ids and where rows end."""
    if isinstance(cells, DenseCells):
        return {"cells": (binning.of(cells) if binning else cells.table).T}
    ends = np.searchsorted(cells.row, np.arange(cells.rows + 1)).astype(np.int32)
    return {"ends": ends, "ids": cells.ids.astype(np.int32), "cells": binning.of(cells) if binning else cells.values}


def block_layout(width: int, absent: str, sparse: bool, binning: Binning | None) -> Layout:
    """How blocks carry features, as values or, with ``binning``, as bins."""
    kind = np.float64 if binning is None else np.uint8
    filler = binning.absent if binning else np.zeros(width) if absent == "zero" and sparse else None

    def cells_of(block: Block) -> DenseCells | SparseCells:
        cells = block.values("cells", kind)
        if not sparse:
            return DenseCells(cells.reshape(width, block.rows).T)
        row = np.repeat(np.arange(block.rows), np.diff(block.values("ends", np.int32)))
        return SparseCells(row, block.values("ids", np.int32).astype(np.int64), cells, block.rows, width, filler)

    return Layout(["ends", "ids", "cells"] if sparse else ["cells"], cells_of, binning is None)


def pack_rows(df: DataFrame, width: int, absent: str, binning: Binning | None, margin: Iterable[float], with_ids: bool) -> DataFrame:
    """Blocks of rows with a label and features, next to a margin they all start from; rows stay in place."""
    sparse, start = sparse_names(df), np.array(list(margin), np.float64)
    names = ["label", *(["indices", "values"] if sparse else ["features"]), *(["row_id"] if with_ids else [])]
    shipped = df.sparkSession.sparkContext.broadcast(binning)

    def pack(batches):
        for whole in batches:
            step = max(1, BLOCK_BYTES * whole.num_rows // max(whole.nbytes, 1))
            for low in range(0, whole.num_rows, step):
                batch = whole.slice(low, step)
                label = np.asarray(batch.column("label").to_numpy(zero_copy_only=False), np.float64)
                columns = {"label": label, **_cell_columns(raw_cells(batch, width, absent), shipped.value)}
                held = {c: _blob(v) for c, v in (columns | {"margin": np.tile(start, (len(label), 1))}).items()}
                if with_ids:
                    held["row_ids"] = pa.ListArray.from_arrays(pa.array([0, len(label)], pa.int32()), batch.column("row_id"))
                yield pa.RecordBatch.from_pydict({"rows": pa.array([len(label)], pa.int32())} | held)

    schema = T.StructType().add("rows", T.IntegerType())
    for name in ("label", *(("ends", "ids", "cells") if sparse else ("cells",)), "margin"):
        schema = schema.add(name, T.BinaryType())
    if with_ids:
        schema = schema.add("row_ids", T.ArrayType(df.schema["row_id"].dataType))
    return map_arrow(df.select(*names), pack, schema)


def map_blocks(table: DataFrame, kept: list[str], new: list[str], change: Callable[[Block], dict[str, np.ndarray]]) -> DataFrame:
    """Every block with its ``kept`` columns and the ``new`` ones that ``change`` gives."""

    def run(batches):
        for block in blocks(batches):
            yield block.with_columns(kept, **change(block))

    schema = T.StructType([table.schema[c] for c in kept])
    for name in new:
        schema = schema.add(name, T.BinaryType())
    return map_arrow(table, run, schema)


def bin_blocks(table: DataFrame, layout: Layout, binning: Binning, keep: list[str]) -> DataFrame:
    """Blocks of values as blocks of bins."""
    shipped = table.sparkSession.sparkContext.broadcast(binning)
    cells_of, names = layout.cells_of, layout.columns
    return map_blocks(table.select(*keep, *names), keep, names, lambda block: _cell_columns(cells_of(block), shipped.value))
