"""Histograms of gradients per tree node: cells that tasks add up, siblings by subtraction, and the best split of a node."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradloom.plans.blocks import blocks
from gradloom.plans.cells import MISSING, DenseCells, Layout, SparseCells
from gradloom.plans.kernels import sum_partials
from gradloom.session import map_arrow

# Bins and the one of missing cells.
SLOTS = MISSING + 1
# Distinct cells a task holds before it sends them on.
HELD_CELLS = 1 << 21
# Values, not binned, a task holds before it sends them on, and tasks that they meet in at most.
HELD_VALUES = 1 << 19
RANGE_TASKS = 4096

Node = tuple[int, int]  # output, node


@dataclass
class Split:
    """The best split of a node; ``n``, ``g``, ``h`` of the whole node and of what goes left."""

    feature: int
    bin: int
    gain: float
    missing_left: bool
    left: tuple[float, float, float]
    whole: tuple[float, float, float]
    threshold: float | None = None


@dataclass
class Rules:
    """How splits are judged: ``gain(g, h)`` of one side, the least weight of a side, what a split costs."""

    gain: Callable
    min_child: float
    gamma: float
    nbins: int


def totals_of(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """n, g and h of the rows of a block that take part, per output."""
    taken = (h > 0).any(axis=1)  # neither left out by the draw nor of weight 0
    return np.stack([np.full(g.shape[1], float(taken.sum())), g[taken].sum(axis=0), h[taken].sum(axis=0)], axis=1)


def node_slots(trees, wanted: list[Node]) -> list[np.ndarray]:
    """Per output, which of the ``wanted`` nodes each node of its tree is, or -1."""
    slots = [np.full(len(t.feature), -1, dtype=np.int64) for t in trees]
    for slot, (output, node) in enumerate(wanted):
        slots[output][node] = slot
    return slots


def node_cells(cells: DenseCells | SparseCells, entries, slot: np.ndarray, g: np.ndarray, h: np.ndarray):
    """(slot, feature, bin, g, h) of every cell whose row is in a wanted node."""
    row, feature, value = entries
    inside = slot[row] >= 0
    row = row[inside]
    return slot[row], feature[inside], value[inside], g[row], h[row]


def add_dense(total: np.ndarray, cells: DenseCells, slot: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
    """Add rows to histograms [n g h, slot, feature, bin], column by column."""
    slots, nbins = total.shape[1], total.shape[3]
    inside = np.flatnonzero(slot >= 0)
    whole = len(inside) == len(slot)
    if not whole:
        g, h = g[inside], h[inside]
    base = slot[inside] * nbins
    for feature in range(cells.width):
        column = cells.table[:, feature] if whole else cells.table[inside, feature]
        at = base + np.where(column == MISSING, nbins - 1, column)
        for part, weights in zip(total, (None, g, h)):
            part[:, feature] += np.bincount(at, weights, slots * nbins).reshape(slots, nbins)


def best_of(n: np.ndarray, g: np.ndarray, h: np.ndarray, whole: np.ndarray, rules: Rules):
    """Best cut of every histogram: (bin, gain, missing_left, left sums). Missing cells may go to either side.

    Arrays are [histograms, bins + 1], the last one for missing cells; ``whole`` has n, g, h of each one's node. Of gains
    that agree in ten digits the lowest bin counts, and missing cells go right.
    """
    nt, gt, ht = (whole[:, i : i + 1] for i in range(3))
    found = None
    for side in (False, True):
        gl, hl, nl = g[:, :-1].cumsum(axis=1), h[:, :-1].cumsum(axis=1), n[:, :-1].cumsum(axis=1)
        if side:
            if not n[:, -1].any():
                break
            gl, hl, nl = gl + g[:, -1:], hl + h[:, -1:], nl + n[:, -1:]
        gr, hr = gt - gl, ht - hl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 0.5 * (rules.gain(gl, hl) + rules.gain(gr, hr) - rules.gain(gt, ht)) - rules.gamma
        legal = (hl >= rules.min_child) & (hr >= rules.min_child) & (hl > 0) & (hr > 0) & (nl > 0) & (nl < nt)
        gain = np.where(legal & np.isfinite(gain), gain, -np.inf)
        at = digits(gain).argmax(axis=1)
        pick = np.arange(len(gain)), at
        now = [at, gain[pick], np.full(len(at), side), np.stack([nl[pick], gl[pick], hl[pick]], axis=1)]
        if found is None:
            found = now
        else:
            better = digits(now[1]) > digits(found[1])
            for old, new in zip(found, now):
                old[better] = new[better]
    return found


def digits(gain: np.ndarray) -> np.ndarray:
    """Ten significant digits: sums that differ by rounding alone are equal."""
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = 10.0 ** (9 - np.floor(np.log10(np.abs(gain))))
        return np.where(np.isfinite(gain) & (gain != 0) & np.isfinite(scale), np.rint(gain * scale) / scale, gain)


def filled(n, g, h, whole, feature: np.ndarray, absent: np.ndarray | None) -> None:
    """Put what the cells leave of their node into the bin of absent entries (``absent[feature]``), else into the missing one."""
    rest = whole[:, 0] - n.sum(axis=1)
    at = np.flatnonzero(rest > 0)
    slot = np.full(len(at), n.shape[1] - 1) if absent is None else absent[feature[at]].astype(np.int64)
    slot = np.where(slot == MISSING, n.shape[1] - 1, slot)
    for part, i in ((n, 0), (g, 1), (h, 2)):
        part[at, slot] += whole[at, i] - part[at].sum(axis=1)


class Grower:
    """Finds the splits of one level after the other for the trees of a round.

    ``rows`` are blocks that hold bins, g and h. The histograms of a level are kept; of two children only the one with fewer rows is summed up
    from rows, the other is what it leaves of the parent. Counts of rows are kept next to the sums, so that empty
    bins come out of a subtraction exactly empty.
    """

    def __init__(self, rows: DataFrame, layout: Layout, width: int, allowed: list[np.ndarray], rules: Rules, absent, parts: int):
        self.rows, self.layout, self.width, self.rules = rows.select("rows", *layout.columns, "g", "h"), layout, width, rules
        self.allowed, self.absent, self.parts = allowed, absent, parts

    def taken_rows(self, trees, wanted: list[Node]):
        """Kernel: (cells, slot of every row or -1, g, h) of every block, output by output."""
        shipped = self.rows.sparkSession.sparkContext.broadcast((trees, node_slots(trees, wanted)))
        cells_of, raw = self.layout.cells_of, self.layout.raw

        def run(batches):
            grown, slots = shipped.value
            for block in blocks(batches):
                cells, g, h = cells_of(block), block.matrix("g"), block.matrix("h")
                taken = (h > 0).any(axis=1)  # neither left out by the draw nor of weight 0
                for output, tree in enumerate(grown):
                    if not (slots[output] >= 0).any():
                        continue
                    slot = np.where(taken, slots[output][tree.leaves(cells, raw)], -1)
                    if (slot >= 0).any():
                        yield cells, slot, g[:, output], h[:, output]

        return run

    def taken_cells(self, trees, wanted: list[Node]):
        """Kernel: (slot, feature, bin, g, h) of every block, output by output."""
        rows_of = self.taken_rows(trees, wanted)

        def run(batches):
            last, entries = None, None
            for cells, slot, g, h in rows_of(batches):
                if cells is not last:
                    last, entries = cells, cells.entries()
                yield node_cells(cells, entries, slot, g, h)

        return run


class DriverGrower(Grower):
    """Histograms as arrays on the driver, for levels of bounded size; tasks add theirs up in slices before."""

    def __init__(self, *args):
        super().__init__(*args)
        self.held: dict[Node, np.ndarray] = {}

    def splits(
        self, trees, active: list[Node], whole: dict[Node, tuple], built: list[Node], sibling: dict[Node, tuple[Node, Node]], keep: bool
    ) -> dict[Node, Split]:
        """The best split of every active node that has one; ``keep`` if a level follows.

        Histograms of ``built`` nodes are summed up from rows, those of ``sibling`` ones are what a built one leaves of
        its parent (sibling: parent and built).
        """
        nbins, width = self.rules.nbins + 1, self.width
        shape = (len(built), width, nbins, 3)
        size = int(np.prod(shape))
        rows_of = self.taken_rows(trees, built)

        def add(batches):
            total = np.zeros((3, len(built), width, nbins))
            for cells, slot, g, h in rows_of(batches):
                if isinstance(cells, DenseCells):
                    add_dense(total, cells, slot, g, h)
                    continue
                slot, feature, value, g, h = node_cells(cells, cells.entries(), slot, g, h)
                at = (slot * width + feature) * nbins + np.where(value == MISSING, nbins - 1, value)
                for part, weights in zip(total, (None, g, h)):
                    part += np.bincount(at, weights, size // 3).reshape(part.shape)
            return 0.0, 0.0, np.moveaxis(total, 0, -1).ravel()

        _, _, sums = sum_partials(self.rows, add, self.parts, size)
        sums = sums.reshape(shape)
        now = {key: sums[i] for i, key in enumerate(built)}
        for key, (parent, other) in sibling.items():
            rest = self.held[parent] - now[other]
            rest[rest[..., 0] == 0] = 0.0
            now[key] = rest
        self.held = now
        found = {}
        for key in active:
            n, g, h = (now[key][..., i].copy() for i in range(3))
            ends = np.tile(np.array(whole[key]), (self.width, 1))
            filled(n, g, h, ends, np.arange(self.width), self.absent)
            cut, gain, left, sums_left = best_of(n, g, h, ends, self.rules)
            gain[~np.isin(np.arange(self.width), self.allowed[key[0]])] = -np.inf
            f = int(digits(gain).argmax())
            if np.isfinite(gain[f]):
                found[key] = Split(f, int(cut[f]), float(gain[f]), bool(left[f]), tuple(sums_left[f]), whole[key])
        return found

    def close(self) -> None:
        self.held = {}


CELLS = "output int, node int, feature int, part int, bin binary, n binary, g binary, h binary"
FOUND = "output int, node int, feature int, bin int, gain double, missing_left boolean, nl double, gl double, hl double, rank double"


class TableGrower(Grower):
    """Histograms as a table by (output, node, feature) that stays on the executors; only filled bins are rows' cells.

    Each task sends the distinct cells of the nodes that are built; those of a node and feature meet with its parent's histogram, which
    gives the sibling's. No task holds more than ``HELD_CELLS`` cells, however many features there are, and the
    driver gets one row per node.
    """

    def __init__(self, *args):
        super().__init__(*args)
        self.table: DataFrame | None = None

    def splits(
        self, trees, active: list[Node], whole: dict[Node, tuple], built: list[Node], sibling: dict[Node, tuple[Node, Node]], keep: bool
    ) -> dict[Node, Split]:
        """The best split of every active node that has one; ``keep`` if a level follows.

        Histograms of ``built`` nodes are summed up from rows, those of ``sibling`` ones are what a built one leaves of
        its parent (sibling: parent and built).
        """
        spark = self.rows.sparkSession
        cells_of, width = self.taken_cells(trees, built), self.width

        def histograms(batches):
            from pyspark import TaskContext

            part, held, size = TaskContext.get().partitionId(), [], 0
            for slot, feature, value, g, h in cells_of(batches):
                held.append(summed((slot * width + feature) * SLOTS + value, np.ones(len(slot)), g, h))
                size += len(held[-1][0])
                if size >= HELD_CELLS:
                    held = [summed(*(np.concatenate(c) for c in zip(*held)))]
                    size = len(held[0][0])
                    if size >= HELD_CELLS // 2:
                        yield packed_cells(*held[0], built, width, part)
                        held, size = [], 0
            if held:
                yield packed_cells(*summed(*(np.concatenate(c) for c in zip(*held))), built, width, part)

        sums = map_arrow(self.rows, histograms, CELLS)
        other_of = {(parent, small): key for key, (parent, small) in sibling.items()}
        by_parent = {parent: small for parent, small in other_of}
        if self.table is not None and by_parent:
            shipped_parents = spark.sparkContext.broadcast(by_parent)

            def as_child(batches):  # a parent's histogram, under the name of the child that is built
                for batch in batches:
                    keys = list(zip(batch.column("output").to_pylist(), batch.column("node").to_pylist()))
                    at = [i for i, key in enumerate(keys) if key in shipped_parents.value]
                    if at:
                        held = batch.take(pa.array(at))
                        nodes = pa.array([shipped_parents.value[keys[i]][1] for i in at], pa.int32())
                        yield held.set_column(held.schema.get_field_index("node"), "node", nodes)

            sums = sums.unionByName(map_arrow(self.table, as_child, CELLS))
        met = sums.repartition("output", "node", "feature").sortWithinPartitions("output", "node", "feature", "part")
        sibling_of = {small: (key, parent) for key, (parent, small) in sibling.items()}
        shipped = spark.sparkContext.broadcast((whole, sibling_of))

        def add_up(batches):
            for keys, parts, cells in grouped(batches):
                own = parts >= 0
                yield from histogram_rows(keys, own, cells, shipped.value[1])

        table = map_arrow(met, add_up, CELLS)
        if keep:
            table = table.persist(StorageLevel.MEMORY_AND_DISK)
        rules, absent, allowed = self.rules, self.absent, self.allowed

        def choose(batches):
            ends = shipped.value[0]
            for keys, _, cells in grouped(batches):
                yield from chosen(keys, cells, ends, rules, absent, allowed)

        best = map_arrow(table, choose, FOUND)
        order = F.struct("rank", (-F.col("feature")).alias("f"))
        best = best.groupBy("output", "node").agg(F.max_by(F.struct(*FOUND_NAMES), order).alias("s")).select("s.*")
        found = {}
        for r in best.collect():  # one row per active node
            key = r["output"], r["node"]
            found[key] = Split(r["feature"], r["bin"], r["gain"], r["missing_left"], (r["nl"], r["gl"], r["hl"]), whole[key])
        self.close()
        self.table = table if keep else None
        return found

    def close(self) -> None:
        if self.table is not None:
            self.table.unpersist()
        self.table = None


FOUND_NAMES = [f.strip().split(" ")[0] for f in FOUND.split(",")]


def lists(column, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def summed(keys: np.ndarray, n: np.ndarray, g: np.ndarray, h: np.ndarray):
    """Distinct keys in order with the sums of n, g and h."""
    found, back = np.unique(keys, return_inverse=True)
    return found, *(np.bincount(back, v, len(found)) for v in (n, g, h))


def packed_cells(keys, n, g, h, nodes: list[Node], width: int, part: int) -> pa.RecordBatch:
    """One row per node and feature from sorted cell keys."""
    groups = keys // SLOTS
    heads = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, np.int64)
    pairs = np.array(nodes, np.int32).reshape(-1, 2)[groups[heads] // width]
    return cell_batch(pairs[:, 0], pairs[:, 1], groups[heads] % width, np.full(len(heads), part), np.r_[heads, len(keys)], keys % SLOTS, n, g, h)


def cell_batch(output, node, feature, part, ends, bins, n, g, h) -> pa.RecordBatch:
    def blobs(values, kind):
        raw = np.ascontiguousarray(values, kind)
        at = (np.asarray(ends) * raw.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw.tobytes())])

    whole = [pa.array(np.asarray(c, np.int32)) for c in (output, node, feature, part)]
    names = ["output", "node", "feature", "part", "bin", "n", "g", "h"]
    return pa.RecordBatch.from_arrays([*whole, blobs(bins, np.uint8), *(blobs(v, np.float64) for v in (n, g, h))], names=names)


def grouped(batches) -> Iterator[tuple[np.ndarray, np.ndarray, tuple]]:
    """Whole groups of sorted rows: (output, node, feature) and part of every row, and its cells (row, bin, n, g, h)."""
    names, carry = ("output", "node", "feature"), None
    for batch in batches:
        table = pa.Table.from_batches([batch] if carry is None else [*carry.to_batches(), batch])
        keys = np.stack([table.column(c).to_numpy() for c in names], axis=1)
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
        last = int(changes[-1]) + 1 if len(changes) else 0
        if last:
            yield _cells(table.slice(0, last), keys[:last])
        carry = table.slice(last)  # its group may go on in the next batch
    if carry is not None and carry.num_rows:
        yield _cells(carry, np.stack([carry.column(c).to_numpy() for c in names], axis=1))


def _cells(table: pa.Table, keys: np.ndarray):
    held = table.combine_chunks()
    lengths = np.array([len(b) for b in held.column("bin").to_pylist()])
    row = np.repeat(np.arange(len(keys)), lengths)
    bins = np.frombuffer(b"".join(held.column("bin").to_pylist()), np.uint8).astype(np.int64)
    values = [np.frombuffer(b"".join(held.column(c).to_pylist()), np.float64) for c in ("n", "g", "h")]
    return keys, held.column("part").to_numpy(), (row, bins, *values)


def histogram_rows(keys, own, cells, sibling_of) -> Iterator[pa.RecordBatch]:
    """The summed histograms of built nodes and, where the parent's is among the rows, those of their siblings."""
    row, bins, *values = cells
    heads = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    group = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).any(axis=1).astype(np.int64)])
    at = group[row] * SLOTS + bins
    mine = own[row]
    n, g, h = (np.bincount(at[mine], v[mine], len(heads) * SLOTS).reshape(-1, SLOTS) for v in values)
    yield from _filled_rows(keys[heads], n, g, h)
    parent = ~mine
    if parent.any():
        np_, gp, hp = (np.bincount(at[parent], v[parent], len(heads) * SLOTS).reshape(-1, SLOTS) for v in values)
        rest = [np_ - n, gp - g, hp - h]
        for r in rest[1:]:
            r[rest[0] == 0] = 0.0
        names = keys[heads].copy()
        names[:, 1] = [sibling_of[int(o), int(c)][0][1] if (int(o), int(c)) in sibling_of else -1 for o, c in keys[heads][:, :2]]
        there = names[:, 1] >= 0
        yield from _filled_rows(names[there], *(r[there] for r in rest))


def _filled_rows(keys, n, g, h) -> Iterator[pa.RecordBatch]:
    some = (n > 0).any(axis=1)
    keys, n, g, h = keys[some], n[some], g[some], h[some]
    if len(keys):
        there = n > 0
        ends = np.r_[0, np.cumsum(there.sum(axis=1))]
        bins = np.nonzero(there)[1]
        yield cell_batch(keys[:, 0], keys[:, 1], keys[:, 2], np.full(len(keys), -1), ends, bins, n[there], g[there], h[there])


def chosen(keys, cells, whole, rules: Rules, absent, allowed) -> Iterator[pa.RecordBatch]:
    """The best cut of every histogram among these rows (one row each)."""
    row, bins, *values = cells
    nbins = rules.nbins + 1
    at = row * nbins + np.where(bins == MISSING, nbins - 1, bins)
    n, g, h = (np.bincount(at, v, len(keys) * nbins).reshape(-1, nbins) for v in values)
    ends = np.array([whole[int(o), int(c)] for o, c in keys[:, :2]])
    filled(n, g, h, ends, keys[:, 2], absent)
    cut, gain, left, sums = best_of(n, g, h, ends, rules)
    good = np.isfinite(gain)
    for output in np.unique(keys[:, 0]):
        mine = keys[:, 0] == output
        good[mine] &= np.isin(keys[mine, 2], allowed[output])
    if good.any():
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(keys[good, i].astype(np.int32)) for i in range(3)), pa.array(cut[good].astype(np.int32)),
                pa.array(gain[good]), pa.array(left[good]), *(pa.array(sums[good, i]) for i in range(3)),
                pa.array(digits(gain[good])),
            ],
            names=FOUND_NAMES,
        )


PIECES = "feature int, range int, part int, seq int, slot binary, value binary, n binary, g binary, h binary"
RANGED = "feature int, range int, slots binary, totals binary, slot binary, value binary, n binary, g binary, h binary"
VALUE_KINDS = {"slot": np.int32, "value": np.float64, "n": np.float64, "g": np.float64, "h": np.float64}


class ExactGrower(Grower):
    """Every distinct value of a column is a cut; values are never binned.

    ``ranges`` cut the values of each column into stretches of some ``RANGE_ROWS`` rows, the same for all levels and rounds. Tasks
    send the distinct values of a stretch and node with their sums, as bytes; those of a stretch meet in one task, which
    adds them up. The sums of its nodes reach the driver, one row a stretch, and tell what the stretches before it hold.
    What the values leave of their node is missing.
    """

    ranges: list[np.ndarray]

    def splits(self, trees, active, whole, built, sibling, keep) -> dict[Node, Split]:
        every, context = list(active), self.rows.sparkSession.sparkContext
        rows_of, width = self.taken_rows(trees, every), self.width
        bounds = context.broadcast(self.ranges)

        def values(batches):
            from pyspark import TaskContext

            part, seq, held, size = TaskContext.get().partitionId(), 0, {}, 0
            for cells, slot, g, h in rows_of(batches):
                for feature in range(width):
                    column = cells.table[:, feature]
                    at = np.flatnonzero((slot >= 0) & ~np.isnan(column))
                    found = value_sums(slot[at], column[at] + 0.0, np.ones(len(at)), g[at], h[at], by_value=True)
                    size += len(found[0])
                    ends = [0, *np.searchsorted(found[1], bounds.value[feature], side="right").tolist(), len(found[0])]
                    for stretch, (low, high) in enumerate(zip(ends, ends[1:])):
                        if high > low:
                            held.setdefault((feature, stretch), []).append([c[low:high] for c in found])
                if size >= HELD_VALUES:
                    yield from _pieces(held, part, seq)
                    seq, held, size = seq + 1, {}, 0
            yield from _pieces(held, part, seq)

        stretches = min(sum(len(b) + 1 for b in self.ranges), RANGE_TASKS)
        met = map_arrow(self.rows, values, PIECES).repartition(max(stretches, 1), "feature", "range")
        met = met.sortWithinPartitions("feature", "range", "part", "seq")

        def merge(batches):
            for feature, stretch, columns in _stretches(batches):
                found = value_sums(*columns)
                heads = np.flatnonzero(np.r_[True, found[0][1:] != found[0][:-1]])
                totals = np.add.reduceat(np.stack(found[2:], axis=1), heads, axis=0)
                yield _value_row({"feature": feature, "range": stretch}, {"slots": found[0][heads].astype(np.int32), "totals": totals}, found)

        ranged = map_arrow(met, merge, RANGED).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ends = ranged.select("feature", "range", "slots", "totals").collect()  # one row a stretch
            before, missing = _carried(ends, every, whole)
            shipped = context.broadcast((before, missing, whole))
            rules, allowed = self.rules, self.allowed

            def choose(batches):
                starts, rest, nodes = shipped.value
                names = np.array(every, np.int32)
                for batch in batches:
                    for at in range(batch.num_rows):
                        slot, value, *sums = _value_columns(batch, at)
                        feature, stretch = batch.column("feature")[at].as_py(), batch.column("range")[at].as_py()
                        heads = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
                        left = np.stack(sums, axis=1)
                        for low, high in zip(heads, [*heads[1:], len(slot)]):
                            left[low:high] = left[low:high].cumsum(axis=0) + starts[feature, stretch][slot[low]]
                        column = np.column_stack([names[slot], np.full(len(slot), feature, np.int32)])
                        yield from _exact_cuts(column, value, left, heads, rest, nodes, rules, allowed)

            return self._best(map_arrow(ranged, choose, EXACT_FOUND), whole)
        finally:
            ranged.unpersist()

    def _best(self, candidates: DataFrame, whole) -> dict[Node, Split]:
        order = F.struct("rank", (-F.col("feature")).alias("f"), (-F.col("value")).alias("v"), (~F.col("missing_left")).alias("m"))
        best = candidates.groupBy("output", "node").agg(F.max_by(F.struct(*EXACT_NAMES), order).alias("s")).select("s.*")
        return {
            (r["output"], r["node"]): Split(
                r["feature"], 0, r["gain"], r["missing_left"], (r["nl"], r["gl"], r["hl"]), whole[r["output"], r["node"]], r["value"]
            )
            for r in best.collect()  # one row per active node
        }

    def close(self) -> None:
        """Nothing is kept between levels."""


EXACT_FOUND = "output int, node int, feature int, value double, gain double, missing_left boolean, nl double, gl double, hl double, rank double"
EXACT_NAMES = [f.strip().split(" ")[0] for f in EXACT_FOUND.split(",")]


def value_sums(slot, value, n, g, h, by_value: bool = False) -> list[np.ndarray]:
    """Distinct (slot, value) with the sums of n, g and h, in the order of slots and values, or of values and slots."""
    order = np.lexsort((slot, value) if by_value else (value, slot))
    slot, value = slot[order], value[order]
    heads = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (value[1:] != value[:-1])]) if len(slot) else np.zeros(0, np.int64)
    if len(heads) == len(slot):
        return [slot, value, n[order], g[order], h[order]]
    return [slot[heads], value[heads], *(np.add.reduceat(c[order], heads) for c in (n, g, h))]


def _value_row(numbers: dict[str, int], more: dict[str, np.ndarray], columns) -> pa.RecordBatch:
    held = more | {name: np.asarray(c, kind) for (name, kind), c in zip(VALUE_KINDS.items(), columns)}
    whole = {name: pa.array([v], pa.int32()) for name, v in numbers.items()}
    return pa.RecordBatch.from_pydict(whole | {name: pa.array([v.tobytes()], pa.binary()) for name, v in held.items()})


def _value_columns(batch: pa.RecordBatch, at: int) -> list[np.ndarray]:
    return [np.frombuffer(batch.column(name)[at].as_buffer(), kind) for name, kind in VALUE_KINDS.items()]


def _pieces(held: dict, part: int, seq: int) -> Iterator[pa.RecordBatch]:
    """One row per stretch that a task holds values of."""
    for (feature, stretch), parts in sorted(held.items()):
        columns = [np.concatenate(c) for c in zip(*parts)]
        yield _value_row({"feature": feature, "range": stretch, "part": part, "seq": seq}, {}, columns)


def _stretches(batches) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Feature, stretch and all values of every stretch, from rows in that order."""
    key, parts = None, []
    for batch in batches:
        for at, now in enumerate(zip(batch.column("feature").to_pylist(), batch.column("range").to_pylist())):
            if now != key and parts:
                yield *key, [np.concatenate(c) for c in zip(*parts)]
                parts = []
            key = now
            parts.append(_value_columns(batch, at))
    if parts:
        yield *key, [np.concatenate(c) for c in zip(*parts)]


def _carried(ends: list, every: list[Node], whole) -> tuple[dict, dict]:
    """By feature and stretch the sums per slot of the stretches before it; by node and feature the sums of rows without a value."""
    before, run = {}, {}
    for r in sorted(ends, key=lambda r: (r["feature"], r["range"])):
        held = run.setdefault(r["feature"], np.zeros((len(every), 3)))
        before[r["feature"], r["range"]] = held.copy()
        held[np.frombuffer(r["slots"], np.int32)] += np.frombuffer(r["totals"]).reshape(-1, 3)
    missing = {}
    for feature, held in run.items():
        for slot, node in enumerate(every):
            if 0 < held[slot, 0] < whole[node][0]:
                missing[(*node, feature)] = tuple(t - v for t, v in zip(whole[node], held[slot]))
    return before, missing


def _exact_cuts(column, value, left, heads, missing, whole, rules: Rules, allowed) -> Iterator[pa.RecordBatch]:
    """The best cut of every run of a column, its missing rows on either side."""
    sizes = np.diff(np.r_[heads, len(column)])
    keys = [tuple(k) for k in column[heads].tolist()]
    total = np.repeat(np.array([whole[k[:2]] for k in keys]), sizes, axis=0)
    rest = np.array([missing.get(k, (0.0, 0.0, 0.0)) for k in keys])
    open_ = np.repeat(np.array([k[2] in allowed[k[0]] for k in keys]), sizes)
    for side in (False, True):
        shown = np.repeat(rest[:, 0] > 0, sizes) if side else np.ones(len(column), bool)
        if not shown.any():
            return
        held = left + np.repeat(rest, sizes, axis=0) if side else left
        other = total - held
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 0.5 * (rules.gain(held[:, 1], held[:, 2]) + rules.gain(other[:, 1], other[:, 2]) - rules.gain(total[:, 1], total[:, 2])) - rules.gamma
        legal = shown & open_ & (held[:, 2] >= rules.min_child) & (other[:, 2] >= rules.min_child) & (held[:, 2] > 0) & (other[:, 2] > 0)
        legal &= (held[:, 0] > 0) & (held[:, 0] < total[:, 0])
        rank = np.where(legal & np.isfinite(gain), digits(gain), -np.inf)
        most = np.maximum.reduceat(rank, heads)
        at = np.flatnonzero(rank == np.repeat(most, sizes))
        run = np.repeat(np.arange(len(heads)), sizes)[at]
        at = at[np.r_[True, run[1:] != run[:-1]]]
        at = at[np.isfinite(rank[at])]
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(column[at, i].astype(np.int32)) for i in range(3)), pa.array(value[at]), pa.array(gain[at]),
                    pa.array(np.full(len(at), side)), *(pa.array(held[at, i]) for i in range(3)), pa.array(rank[at]),
                ],
                names=EXACT_NAMES,
            )
