"""Batches of rows as cells of features: dense or sparse, raw or binned, for trees to look up and histograms to add."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.plans.kernels import sum_partials
from gradloom.session import map_arrow

# The bin of NaN cells and, where absent entries are missing, of these.
MISSING = 255
# How absent entries of sparse rows are read.
ABSENT = ("zero", "missing")


class DenseCells:
    """A matrix of values (NaN is missing) or of bins."""

    def __init__(self, table: np.ndarray):
        self.table, self.rows, self.width = table, *table.shape

    def at(self, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and whether they are missing, of one feature of every row."""
        values = self.table[row, feature]
        return values, values == MISSING if values.dtype == np.uint8 else np.isnan(values)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, feature and value of every cell."""
        row = np.repeat(np.arange(self.rows), self.width)
        return row, np.tile(np.arange(self.width), self.rows), self.table.ravel()


class SparseCells:
    """Entries in the order of rows and features; what is absent has ``absent[feature]`` (a bin) or 0, or is missing."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, values: np.ndarray, rows: int, width: int, absent: np.ndarray | None):
        self.row, self.ids, self.values, self.rows, self.width, self.absent = row, ids, values, rows, width, absent
        self.keys = row * width + ids

    def at(self, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = row * self.width + feature
        place = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        found = self.keys[place] == wanted if len(self.keys) else np.zeros(len(wanted), bool)
        held = self.values[place[found]]
        if self.absent is None:
            values, missing = np.zeros(len(wanted), self.values.dtype), ~found
        else:
            values, missing = self.absent[feature].astype(self.values.dtype), np.zeros(len(wanted), bool)
        values[found] = held
        missing[found] = held == MISSING if self.values.dtype == np.uint8 else np.isnan(held)
        return values, missing

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.row, self.ids, self.values


def sparse_names(df: DataFrame) -> bool:
    """Whether rows are ``indices``/``values``."""
    return "features" not in df.columns


def raw_cells(batch: pa.RecordBatch, width: int, absent: str) -> DenseCells | SparseCells:
    """The features of a batch as they are; repeated ids add up, ids at or beyond ``width`` are left out."""
    if "features" in batch.schema.names:
        flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
        return DenseCells(np.asarray(flat, np.float64).reshape(batch.num_rows, width))
    lists = batch.column("indices")
    ids = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64)
    values = np.asarray(batch.column("values").flatten().to_numpy(zero_copy_only=False), np.float64)
    row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    inside = (ids >= 0) & (ids < width)
    row, ids, values = row[inside], ids[inside], values[inside]
    keys = row * width + ids
    filler = np.zeros(width) if absent == "zero" else None
    if (keys[1:] > keys[:-1]).all():
        return SparseCells(row, ids, values, batch.num_rows, width, filler)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    values = np.add.reduceat(values, heads) if len(heads) else values
    return SparseCells(keys[heads] // width, keys[heads] % width, values, batch.num_rows, width, filler)


class Binning:
    """Cuts per feature; bin b holds values up to and including cut b that lie beyond cut b - 1."""

    def __init__(self, edges: Sequence[np.ndarray], absent: str):
        self.sizes = np.array([len(e) for e in edges])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.edges, self.width = list(edges), len(edges)
        zero = np.array([np.searchsorted(e, 0.0, side="left") for e in edges], np.uint8)
        self.absent = zero if absent == "zero" else None

    def of(self, cells: DenseCells | SparseCells) -> np.ndarray:
        """The bin of every entry."""
        if isinstance(cells, DenseCells):
            bins = np.empty(cells.table.shape, np.uint8, order="F")
            for j, cut in enumerate(self.edges):
                bins[:, j] = np.searchsorted(cut, cells.table[:, j], side="left")
            bins[np.isnan(cells.table)] = MISSING
            return bins
        bins = np.empty(len(cells.ids), np.uint8)
        order = np.argsort(cells.ids, kind="stable")
        ids = cells.ids[order]
        heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
        for low, high in zip(heads, np.r_[heads[1:], len(ids)]):
            at = order[low:high]
            bins[at] = np.searchsorted(self.edges[ids[low]], cells.values[at], side="left")
        bins[np.isnan(cells.values)] = MISSING
        return bins


def bin_rows(df: DataFrame, binning: Binning, keep: Sequence[str], absent: str) -> DataFrame:
    """Features as one byte a cell (``bins``), for sparse rows next to the ``ids`` they hold; rows stay in place."""
    shipped = df.sparkSession.sparkContext.broadcast(binning)
    sparse = sparse_names(df)
    names = ["indices", "values"] if sparse else ["features"]

    def to_bins(batches):
        held = shipped.value
        for batch in batches:
            cells = raw_cells(batch, held.width, absent)
            bins = held.of(cells)
            columns = [batch.column(c) for c in keep]
            if sparse:
                ends = np.searchsorted(cells.row, np.arange(batch.num_rows + 1)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.ids.astype(np.int32))))
            else:
                ends = (np.arange(batch.num_rows + 1) * held.width).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(bins.tobytes())])
            yield pa.RecordBatch.from_arrays([*columns, packed], names=[*keep, *(["ids"] if sparse else []), "bins"])

    schema = df.select(*keep).schema
    if sparse:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return map_arrow(df.select(*keep, *names), to_bins, schema.add("bins", T.BinaryType()))


def binned_cells(batch: pa.RecordBatch, binning: Binning) -> DenseCells | SparseCells:
    """The cells that ``bin_rows`` wrote."""
    column = batch.column("bins")
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + batch.num_rows + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    bins = whole[ends[0] : ends[-1]] if len(ends) else whole[:0]
    if "ids" not in batch.schema.names:
        return DenseCells(bins.reshape(batch.num_rows, binning.width))
    ids = batch.column("ids").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
    return SparseCells(row, ids, bins, batch.num_rows, binning.width, binning.absent)


@dataclass
class Layout:
    """How rows carry their features: the columns, and how a batch becomes cells, as values (``raw``) or bins."""

    columns: list[str]
    cells_of: Callable[[pa.RecordBatch], DenseCells | SparseCells]
    raw: bool


def raw_layout(df: DataFrame, width: int, absent: str) -> Layout:
    return Layout(["indices", "values"] if sparse_names(df) else ["features"], lambda batch: raw_cells(batch, width, absent), True)


def binned_layout(df: DataFrame, binning: Binning) -> Layout:
    return Layout([*(["ids"] if "ids" in df.columns else []), "bins"], lambda batch: binned_cells(batch, binning), False)


# -- weighted quantiles ---------------------------------------------------------------------------------------

# Points of a summary for every cut that is asked of it. A summary that loses points moves ranks by 1 / points at most.
SUMMARY_POINTS = 32


def pruned(values: np.ndarray, weights: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``points`` of the sorted values, at even steps of weight; the weight between two goes to the later one."""
    if len(values) <= points:
        return values, weights
    ends = np.cumsum(weights)
    at = np.unique(np.searchsorted(ends, ends[-1] * np.arange(1, points + 1) / points, side="left").clip(max=len(values) - 1))
    kept = ends[at]
    return values[at], np.diff(kept, prepend=0.0)


def joined(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of several summaries with the sums of their weights."""
    values, weights = (np.concatenate(p) for p in zip(*parts))
    found, back = np.unique(values, return_inverse=True)
    return found, np.bincount(back, weights, len(found))


class Tower:
    """Summaries merged two by two, so that a value is pruned as often as the number of parts doubles."""

    def __init__(self, points: int):
        self.points, self.levels = points, []

    def add(self, values: np.ndarray, weights: np.ndarray) -> None:
        held, level = (values, weights), 0
        while level < len(self.levels) and self.levels[level] is not None:
            held = pruned(*joined([self.levels[level], held]), self.points)
            self.levels[level] = None
            level += 1
        if level == len(self.levels):
            self.levels.append(None)
        self.levels[level] = held

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        return joined([h for h in self.levels if h is not None])


def cuts_of(values: np.ndarray, weights: np.ndarray, max_bin: int) -> np.ndarray:
    """The distinct values at ranks 1/max_bin, 2/max_bin, ... of the weight."""
    ends = np.cumsum(weights)
    if not len(ends) or not ends[-1] > 0:
        return np.zeros(0)
    # A rank that rounding puts just beyond a value's end still is that value's.
    ranks = ends[-1] * np.arange(1, max_bin) / max_bin * (1.0 - 1e-12)
    return np.unique(values[np.searchsorted(ends, ranks, side="left").clip(max=len(values) - 1)])


def weighted_edges(df: DataFrame, width: int, max_bin: int, absent: str = "zero", weight: str | None = None, layout: Layout | None = None) -> list[np.ndarray]:
    """At most ``max_bin - 1`` cuts per feature at even steps of ``weight`` (rows, if None), dense or sparse.

    Each task sums up its cells in mergeable summaries of bounded size; those of a feature meet in one task and are merged
    in task order; the driver gets the cuts. With ``layout`` the table holds blocks, whose weights are summed over outputs. Absent entries that count as 0 are one value whose weight is what the others
    leave of the total. Missing cells have no say. Features without any cell get no cut.
    """
    points = SUMMARY_POINTS * max_bin
    names = ["indices", "values"] if sparse_names(df) else ["features"]
    chosen = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    sparse = sparse_names(df) if layout is None else "ids" in layout.columns

    def weighed(batches):
        """Cells and weights of the rows of every batch or block."""
        if layout is None:
            for batch in batches:
                yield raw_cells(batch, width, absent), batch.column("_weight").to_numpy(zero_copy_only=False)
        else:
            from gradloom.plans.blocks import blocks

            for block in blocks(batches):
                yield layout.cells_of(block), np.ones(block.rows) if weight is None else block.matrix(weight).sum(axis=1)

    def summarise(batches):
        from pyspark import TaskContext

        towers: dict[int, Tower] = {}
        part = TaskContext.get().partitionId()
        for cells, w in weighed(batches):
            row, ids, values = cells.entries()
            good = ~np.isnan(values) & (w[row] > 0)
            row, ids, values = row[good], ids[good], values[good]
            order = np.lexsort((values, ids))
            ids, values, weights = ids[order], values[order], w[row][order]
            heads = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (values[1:] != values[:-1])]) if len(ids) else np.zeros(0, np.int64)
            sums = np.add.reduceat(weights, heads) if len(heads) else weights
            ids, values = ids[heads], values[heads] + 0.0
            first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
            for low, high in zip(first.tolist(), np.r_[first[1:], len(ids)].tolist()):
                towers.setdefault(int(ids[low]), Tower(points)).add(*pruned(values[low:high], sums[low:high], points))
        for feature in sorted(towers):
            yield _summary_rows([(feature, part, *towers[feature].whole())])

    def merge(batches):
        feature, tower = None, None
        for batch in batches:  # sorted by feature and part
            for r in batch.to_pylist():
                if r["feature"] != feature:
                    if tower is not None:
                        yield _summary_rows([(feature, 0, *pruned(*tower.whole(), points))])
                    feature, tower = r["feature"], Tower(points)
                tower.add(np.frombuffer(r["at"]), np.frombuffer(r["weights"]))
        if tower is not None:
            yield _summary_rows([(feature, 0, *pruned(*tower.whole(), points))])

    schema = "feature int, part int, at binary, weights binary"
    if layout is None:
        source = df.select(*names, chosen.alias("_weight"))
    else:
        source = df.select("rows", *layout.columns, *([] if weight is None else [weight]))
    parts = map_arrow(source, summarise, schema)
    met = parts.repartition("feature").sortWithinPartitions("feature", "part").mapInArrow(merge, schema)
    total = None
    if sparse and absent == "zero":
        if layout is None:
            total = df.agg(F.sum(chosen)).head()[0] or 0.0
        else:
            _, total, _ = sum_partials(source, lambda batches: (0.0, sum(float(w.sum()) for _, w in weighed(batches)), np.zeros(0)), 1, 0)

    def cut(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at, weights = np.frombuffer(r["at"]), np.frombuffer(r["weights"])
                rest = 0.0 if total is None else total - float(weights.sum())
                if total is not None and rest > 1e-9 * total:
                    at, weights = joined([(at, weights), (np.zeros(1), np.array([rest]))])
                yield _summary_rows([(r["feature"], 0, cuts_of(at, weights, max_bin), np.zeros(0))])

    edges = [np.zeros(0) for _ in range(width)]
    for r in map_arrow(met, cut, schema).collect():  # cuts of one feature each
        edges[r["feature"]] = np.frombuffer(r["at"]).copy()
    return edges


def _summary_rows(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "feature": pa.array([r[0] for r in rows], pa.int32()), "part": pa.array([r[1] for r in rows], pa.int32()),
        "at": [np.ascontiguousarray(r[2], np.float64).tobytes() for r in rows],
        "weights": [np.ascontiguousarray(r[3], np.float64).tobytes() for r in rows],
    })
