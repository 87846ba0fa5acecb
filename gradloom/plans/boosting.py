"""Boosted trees grown level by level from distributed gradient histograms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.functions.hashing import draw, draw_column
from gradloom.functions.vectors import sparse_to_dense
from gradloom.plans import objectives
from gradloom.plans.blocks import Block, bin_blocks, block_layout, blocks, map_blocks, pack_rows
from gradloom.plans.cells import (
    ABSENT, MISSING, Binning, Layout, bin_rows, binned_layout, raw_layout, sparse_names, weighted_edges,
)
from gradloom.plans.histograms import DriverGrower, ExactGrower, Grower, Rules, TableGrower, lists, totals_of
from gradloom.plans.kernels import check_broadcast, feature_width, sum_partials
from gradloom.session import local_table, map_arrow, persist_balanced, reliable_checkpoint

# Histograms of a level that the driver holds; larger ones stay on the executors as a table.
HISTOGRAM_BYTES = 128 * 1024 * 1024
# Rounds after which rows and their margins are checkpointed, so that a lost executor recomputes no more than these.
REFRESH_ROUNDS = 10
# Tasks per core and pass: each sends one set of histograms, so their number follows the cluster and not the data.
TASKS_PER_CORE = 4
# Quantiles asked of one aggregation pass.
COLUMNS_PER_PASS = 256
# Rows whose values meet in one task where every value is a cut.
RANGE_ROWS = 500_000
TREE_METHODS = ("auto", "hist", "approx", "exact")


@dataclass(frozen=True)
class BoosterParams:
    """The names of the settings, but for ``reg_lambda`` and ``reg_alpha``, which also go by their own.

    ``absent`` says whether entries that sparse rows leave out are 0 or missing; NaN is always missing. ``max_bin`` beyond 255
    counts as 255.
    """

    eta: float = 0.3
    gamma: float = 0.0
    max_depth: int = 6
    min_child_weight: float = 1.0
    max_delta_step: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    lambda_bias: float = 0.0
    tree_method: str = "auto"
    grow_policy: str = "depthwise"
    scale_pos_weight: float = 1.0
    drop_rate: float = 0.0
    skip_drop: float = 0.0
    max_bin: int = 64
    num_feature: int | None = None
    absent: str = "zero"

    @classmethod
    def of(cls, options: dict) -> BoosterParams:
        """From user options; ``lambda`` and ``alpha`` are accepted by these names."""
        renamed = {{"lambda": "reg_lambda", "alpha": "reg_alpha"}.get(k, k): v for k, v in options.items()}
        params = cls(**renamed)
        if params.tree_method not in TREE_METHODS:
            raise ValueError(f"tree_method {params.tree_method!r} is not one of {TREE_METHODS}")
        if params.absent not in ABSENT:
            raise ValueError(f"absent {params.absent!r} is not one of {ABSENT}")
        if params.grow_policy != "depthwise":
            raise ValueError("grow_policy must be depthwise")
        if not 2 <= params.max_bin <= 256:
            raise ValueError("max_bin must lie between 2 and 256")
        return replace(params, max_bin=min(params.max_bin, MISSING))

    @property
    def binned(self) -> bool:
        """Whether one set of cuts serves all rounds."""
        return self.tree_method in ("auto", "hist")


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` is -1 at leaves. Rows with bin <= ``bin`` go left, missing ones if ``missing`` is 1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    missing: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, bin: int, threshold: float, gain: float, missing_left: bool = False) -> int:
        """Turn a leaf into a split; its children are the returned node and the one after it."""
        child = len(self.feature)
        self.feature[node], self.bin[node], self.threshold[node] = feature, bin, threshold
        self.left[node], self.gain[node], self.missing[node] = child, gain, int(missing_left)
        for _ in range(2):
            for values, empty in ((self.feature, -1), (self.bin, 0), (self.threshold, 0.0), (self.left, 0),
                                  (self.value, 0.0), (self.gain, 0.0), (self.missing, 0)):
                values.append(empty)
        return child

    def leaves(self, cells, raw: bool = False) -> np.ndarray:
        """Leaf of every row, by bins or, for raw cells, by thresholds."""
        feature, left = np.array(self.feature), np.array(self.left)
        cuts, missing = np.array(self.threshold if raw else self.bin), np.array(self.missing) > 0
        node, rows = np.zeros(cells.rows, dtype=np.int64), np.arange(cells.rows)
        while len(rows := rows[feature[node[rows]] >= 0]):
            at = node[rows]
            value, absent = cells.at(rows, feature[at])
            node[rows] = left[at] + np.where(absent, ~missing[at], ~(value <= cuts[at]))
        return node


def bin_edges(df: DataFrame, width: int, max_bin: int) -> list[np.ndarray]:
    """At most ``max_bin - 1`` cut values per feature from distributed quantile summaries.

    A feature with few, well-filled values gets each of them as a cut, which makes its splits exact.
    """
    grid = F.lit([i / max_bin for i in range(1, max_bin)])
    accuracy = F.lit(max(1000, 16 * max_bin))
    edges: list[np.ndarray] = []
    for start in range(0, width, COLUMNS_PER_PASS):
        wanted = range(start, min(start + COLUMNS_PER_PASS, width))
        row = df.agg(*[F.percentile_approx(F.get("features", F.lit(j)), grid, accuracy).alias(f"q{j}") for j in wanted])
        edges += [np.unique(np.array(q or [], dtype=np.float64)) for q in row.head()]
    return edges


Weighted = list[tuple[int, Tree, float]]


def _added(margin: np.ndarray, cells, trees: Weighted, raw: bool) -> np.ndarray:
    """The margins of a batch plus (output, tree, scale) terms."""
    out = margin.copy()
    for output, tree, scale in trees:
        out[:, output] += scale * np.array(tree.value)[tree.leaves(cells, raw)]
    return out


def _shrink(g, alpha):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def _gain(g, h, p: BoosterParams):
    return _shrink(g, p.reg_alpha) ** 2 / (h + p.reg_lambda)


def leaf_value(g: float, h: float, p: BoosterParams) -> float:
    value = -float(_shrink(g, p.reg_alpha)) / (h + p.reg_lambda) if h + p.reg_lambda > 0 else 0.0
    if p.max_delta_step:
        value = float(np.clip(value, -p.max_delta_step, p.max_delta_step))
    return p.eta * value


def grow_round(
    rows: DataFrame, layout: Layout, nout: int, width: int, binning: Binning | None, p: BoosterParams, seed, round_, parts, totals, ranges=None
) -> list[Tree]:
    """One tree per output, level by level, from the ``totals`` of all rows.

    Without ``binning`` every value is a cut, and ``ranges`` say which meet in one task.
    """
    trees = [Tree() for _ in range(nout)]
    columns = []
    for output in range(nout):
        if p.colsample < 1.0:
            order = sorted(range(width), key=lambda j: (draw(seed, round_, output, j), j))
            columns.append(np.sort(order[: max(1, round(p.colsample * width))]))
        else:
            columns.append(np.arange(width))
    rules = Rules(lambda g, h: _gain(g, h, p), p.min_child_weight, p.gamma, p.max_bin)
    grower = _grower(nout, width, binning, p)(rows, layout, width, columns, rules, binning.absent if binning and "ids" in layout.columns else None, parts)
    if isinstance(grower, ExactGrower):
        grower.ranges = ranges
    active = [(output, 0) for output in range(nout)]
    whole = dict(zip(active, totals))
    built, sibling = active, {}
    for (output, _), (_, g, h) in whole.items():
        trees[output].value[0] = leaf_value(g, h, p)
    try:
        for level in range(p.max_depth):
            found = grower.splits(trees, active, whole, built, sibling, level + 1 < p.max_depth)
            active, built, sibling, children = [], [], {}, {}
            for (output, node), s in sorted(found.items()):
                if not s.gain > 1e-12:
                    continue
                tree = trees[output]
                threshold = float(binning.edges[s.feature][s.bin]) if binning else s.threshold
                child = tree.split(node, s.feature, s.bin, threshold, s.gain, s.missing_left)
                sides = [(output, child), (output, child + 1)]
                children[sides[0]], children[sides[1]] = s.left, tuple(t - v for t, v in zip(s.whole, s.left))
                for side in sides:
                    _, g, h = children[side]
                    tree.value[side[1]] = leaf_value(g, h, p)
                small, large = sorted(sides, key=lambda side: (children[side][0], side))
                active += sides
                built.append(small)
                sibling[large] = ((output, node), small)
            whole = children
            if not active:
                break
    finally:
        grower.close()
    return trees


def _grower(nout: int, width: int, binning: Binning | None, p: BoosterParams) -> type[Grower]:
    """Arrays on the driver while those of the widest level stay small, else a table; no histograms without bins."""
    if binning is None:
        return ExactGrower
    level = 24 * nout * 2 ** max(p.max_depth - 1, 0) * width * (p.max_bin + 1)
    return DriverGrower if level <= HISTOGRAM_BYTES else TableGrower


@dataclass
class TreeEnsemble:
    """``rounds[r][output]`` trees with one scale per round."""

    objective: str
    nout: int
    width: int
    start: float
    absent: str = "zero"
    edges: list[np.ndarray] = field(default_factory=list)
    rounds: list[list[Tree]] = field(default_factory=list)
    scales: list[float] = field(default_factory=list)

    @property
    def size(self) -> int:
        return sum(48 * len(t.feature) for trees in self.rounds for t in trees)

    def terms(self, rounds: Sequence[int], factor: float = 1.0) -> Weighted:
        """What these rounds add to a margin, times ``factor``."""
        return [(o, t, factor * self.scales[r]) for r in rounds for o, t in enumerate(self.rounds[r])]

    def arrays(self) -> dict[str, np.ndarray]:
        """Flat tables for a snapshot: one row per node."""
        nodes = [
            (r, o, n, t.feature[n], t.bin[n], t.threshold[n], t.left[n], t.value[n], t.gain[n], t.missing[n])
            for r, trees in enumerate(self.rounds) for o, t in enumerate(trees) for n in range(len(t.feature))
        ]
        return {
            "nodes": np.array(nodes, dtype=np.float64).reshape(-1, 10),
            "scales": np.array(self.scales, dtype=np.float64),
            "edges": np.concatenate([*self.edges, np.zeros(0)]),
            "cuts": np.array([len(cut) for cut in self.edges], dtype=np.float64),
            "shape": np.array([objectives.OBJECTIVES.index(self.objective), self.nout, self.width, self.start, ABSENT.index(self.absent)]),
        }

    @classmethod
    def from_arrays(cls, arrays: dict[str, np.ndarray]) -> TreeEnsemble:
        code, nout, width, start, *absent = arrays["shape"]  # snapshots of older versions end here
        model = cls(objectives.OBJECTIVES[int(code)], int(nout), int(width), float(start), ABSENT[int(absent[0])] if absent else "zero")
        model.scales = [float(s) for s in arrays["scales"]]
        model.edges = np.split(arrays["edges"], np.cumsum(arrays["cuts"].astype(int))[:-1])
        model.rounds = [[Tree([], [], [], [], [], [], []) for _ in range(model.nout)] for _ in model.scales]
        for r, o, _, feature, bin_, threshold, left, value, gain, *missing in arrays["nodes"]:
            tree = model.rounds[int(r)][int(o)]
            tree.feature.append(int(feature))
            tree.bin.append(int(bin_))
            tree.threshold.append(threshold)
            tree.left.append(int(left))
            tree.value.append(value)
            tree.gain.append(gain)
            tree.missing.append(int(missing[0]) if missing else 0)
        return model

    def split_table(self, spark: SparkSession) -> DataFrame:
        """All nodes as rows; model-sized."""
        rows = [
            (r, o, n, t.feature[n], t.threshold[n], t.gain[n], t.value[n], self.scales[r], t.missing[n] > 0)
            for r, trees in enumerate(self.rounds) for o, t in enumerate(trees) for n in range(len(t.feature))
        ]
        return local_table(
            spark, rows,
            "round int, output int, node int, feature int, threshold double, gain double, value double, scale double, missing_left boolean",
        )


def dense_rows(df: DataFrame, width: int) -> DataFrame:
    """Dense rows of sparse ones; absent entries are 0."""
    return df if "features" in df.columns else sparse_to_dense(df, width)


def _score_batch(kept: Sequence[str], batch: pa.RecordBatch, objective: str, margin: np.ndarray) -> pa.RecordBatch:
    out = objectives.scores(objective, margin)
    offsets = pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32))
    return pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in kept], pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], names=[*kept, "scores"]
    )


def ensemble_scores(df: DataFrame, model: TreeEnsemble) -> DataFrame:
    """All columns but the features, plus ``scores``; sparse rows are looked up as they are."""
    check_broadcast(model.size, "the ensemble")
    shipped = df.sparkSession.sparkContext.broadcast(model)
    layout = raw_layout(df, model.width, model.absent)
    kept = [c for c in df.columns if c not in layout.columns]

    def score(batches):
        held = shipped.value
        terms = held.terms(range(len(held.rounds)))
        for batch in batches:
            cells = layout.cells_of(batch)
            yield _score_batch(kept, batch, held.objective, _added(np.full((batch.num_rows, held.nout), held.start), cells, terms, True))

    schema = df.select(*kept).schema.add("scores", T.ArrayType(T.DoubleType()))
    return map_arrow(df.select(*kept, *layout.columns), score, schema)


class Margins:
    """Rows that carry their margin and take in new trees only, so that scoring them costs the same at every round."""

    def __init__(self, rows: DataFrame, keep: Sequence[str], layout: Layout, model: TreeEnsemble):
        self.rows = rows.select(*keep, *layout.columns, F.array(*[F.lit(model.start)] * model.nout).alias("margin"))
        self.keep, self.layout, self.objective = list(keep), layout, model.objective
        self.waiting: Weighted = model.terms(range(len(model.rounds)))
        self.rounds, self.held = 0, None

    def add(self, terms: Weighted) -> None:
        self.waiting = self.waiting + terms

    def scores(self) -> DataFrame:
        """The kept columns and ``scores``, with all trees added so far."""
        shipped = self.rows.sparkSession.sparkContext.broadcast(self.waiting)
        layout, kept, objective = self.layout, self.keep, self.objective

        def move(batches):
            for batch in batches:
                margin = _added(lists(batch.column("margin"), batch.num_rows), layout.cells_of(batch), shipped.value, layout.raw)
                column = pa.ListArray.from_arrays(pa.array(np.arange(0, margin.size + 1, margin.shape[1], dtype=np.int32)), pa.array(margin.ravel()))
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", column)

        def score(batches):
            for batch in batches:
                yield _score_batch(kept, batch, objective, lists(batch.column("margin"), batch.num_rows))

        moved = map_arrow(self.rows, move, self.rows.schema)
        self.rounds += 1
        moved = (reliable_checkpoint(moved) if self.rounds % REFRESH_ROUNDS == 0 else moved).persist(StorageLevel.MEMORY_AND_DISK)
        moved.count()
        self.close()
        self.rows, self.held, self.waiting = moved, moved, []
        return map_arrow(moved, score, moved.select(*kept).schema.add("scores", T.ArrayType(T.DoubleType())))

    def close(self) -> None:
        if self.held is not None:
            self.held.unpersist()
            self.held = None


def train_trees(
    train: DataFrame, objective: str, booster: str, nclasses: int, iterations: int, base_score: float, seed: int,
    p: BoosterParams, model: TreeEnsemble | None = None, after_round=None, checks: DataFrame | None = None,
) -> TreeEnsemble:
    """Grow ``iterations`` rounds on top of ``model``; ``after_round(model, scored, loss)`` sees every finished round.

    ``scored()`` gives label, split and scores of the rows of ``checks``; ``scored`` is None without any. ``loss()`` gives
    the loss of the training rows.
    """
    nout = objectives.outputs(objective, nclasses)
    width = model.width if model else p.num_feature or feature_width(train)
    rows = train if not sparse_names(train) or p.tree_method != "exact" else dense_rows(train, width)
    if model is None:
        model = TreeEnsemble(objective, nout, width, objectives.start_margin(objective, base_score), p.absent)
    source, sparse = rows.withColumn("label", F.col("label").cast("double")), sparse_names(rows)
    start, with_ids = [model.start] * nout, p.subsample < 1.0
    layout, binning, raw = block_layout(width, model.absent, sparse, None), None, None
    if not p.binned:
        table = pack_rows(source, width, model.absent, None, start, with_ids)
    else:
        if not model.edges and sparse:
            # Sparse rows are read (often from text) once, for their cuts and for their bins.
            raw = pack_rows(source, width, model.absent, None, start, with_ids).persist(StorageLevel.MEMORY_AND_DISK)
        edges = model.edges or (weighted_edges(raw, width, p.max_bin, model.absent, layout=layout) if sparse else bin_edges(source, width, p.max_bin))
        if any(len(cut) >= p.max_bin for cut in edges):
            raise ValueError(f"the model has more cuts than max_bin={p.max_bin} allows")
        model.edges, binning = edges, Binning(edges, model.absent)
        check_broadcast(8 * int(binning.sizes.sum()), "the cuts")
        if raw is None:
            table = pack_rows(source, width, model.absent, binning, start, with_ids)
        else:
            table = bin_blocks(raw, layout, binning, [c for c in raw.columns if c not in layout.columns])
        layout = block_layout(width, model.absent, sparse, binning)
    table, parts = persist_balanced(table, F.octet_length("cells") + F.col("rows") * F.lit(24 * nout + 8))
    if raw is not None:
        raw.unpersist()
    tasks = TASKS_PER_CORE * train.sparkSession.sparkContext.defaultParallelism
    partitions = table.rdd.getNumPartitions()
    parts = min(partitions, tasks)
    ranges = _ranges(table, layout, width) if p.tree_method == "exact" else None
    fresh = model.terms(range(len(model.rounds)))
    watched = _watched(checks, model, binning)
    try:
        for done in range(iterations):
            round_ = len(model.rounds)
            dropped: list[int] = []
            if booster == "dart":
                if draw(seed, round_, "skip") >= p.skip_drop:
                    dropped = [r for r in range(round_) if draw(seed, round_, "drop", r) < p.drop_rate]
            check_broadcast(model.size, "the ensemble")
            cut = done % REFRESH_ROUNDS == REFRESH_ROUNDS - 1
            table, totals = _advance(table, layout, fresh, model.terms(dropped, -1.0), objective, nout, partitions, p, seed, round_, cut)
            trees = _grown(table, layout, nout, width, binning, model, p, seed, round_, parts, tasks, totals, ranges)
            scale, fresh = 1.0, []
            if dropped:
                scale = 1.0 / (len(dropped) + p.eta)
                # Dropped trees come back at a smaller scale: only the difference is added to the margins.
                fresh = model.terms(dropped, len(dropped) / (len(dropped) + p.eta) - 1.0)
                for r in dropped:
                    model.scales[r] *= len(dropped) / (len(dropped) + p.eta)
            model.rounds.append(trees)
            model.scales.append(scale)
            fresh += model.terms([round_])
            if watched is not None:
                watched.add(fresh)
            if after_round is not None:
                own_loss = partial(_own_loss, table.coalesce(tasks), layout, fresh, objective, parts)
                after_round(model, watched.scores if watched is not None else None, own_loss)
    finally:
        table.unpersist()
        if watched is not None:
            watched.close()
    return model


def _grown(table, layout: Layout, nout: int, width: int, binning: Binning | None, model: TreeEnsemble, p: BoosterParams, seed, round_, parts, tasks, totals, ranges):
    """The trees of a round. ``approx`` proposes cuts of equal second derivatives anew for each."""
    if p.tree_method != "approx":
        return grow_round(table.coalesce(tasks), layout, nout, width, binning, p, seed, round_, parts, totals, ranges)
    model.edges = weighted_edges(table, width, p.max_bin, model.absent, "h", layout)
    binning = Binning(model.edges, model.absent)
    rows = bin_blocks(table, layout, binning, ["rows", "g", "h"]).persist(StorageLevel.MEMORY_AND_DISK)
    binned = block_layout(width, model.absent, "ids" in layout.columns, binning)
    try:
        return grow_round(rows.coalesce(tasks), binned, nout, width, binning, p, seed, round_, parts, totals)
    finally:
        rows.unpersist()


def _ranges(table: DataFrame, layout: Layout, width: int) -> list[np.ndarray]:
    """Bounds of the values of every column that cut it into stretches of some ``RANGE_ROWS`` rows."""
    rows = table.agg(F.sum("rows")).head()[0] or 0
    wanted = -(-rows // RANGE_ROWS)
    return [np.zeros(0)] * width if wanted < 2 else weighted_edges(table, width, wanted, layout=layout)


def _watched(checks: DataFrame | None, model: TreeEnsemble, binning: Binning | None) -> Margins | None:
    """Validation rows as their margins; sets in another layout than the training rows are read raw."""
    if checks is None:
        return None
    keep = [c for c in checks.columns if c in ("label", "split", "row_id")]
    if binning is None:
        return Margins(checks, keep, raw_layout(checks, model.width, model.absent), model)
    binned = bin_rows(checks, binning, keep, model.absent)
    return Margins(binned, keep, binned_layout(binned, binning), model)


def _own_loss(table: DataFrame, layout: Layout, fresh: Weighted, objective: str, parts: int) -> list[tuple[str, str, float]]:
    """Mean loss of the training rows from the margins they carry and the trees of the last round; tasks send sums only."""
    shipped = table.sparkSession.sparkContext.broadcast(fresh)

    def add(batches):
        loss, rows = 0.0, 0
        for block in blocks(batches):
            margin = _added(block.matrix("margin"), layout.cells_of(block), shipped.value, layout.raw)
            loss += float(objectives.losses(objective, margin, block.values("label")).sum())
            rows += block.rows
        return loss, float(rows), np.zeros(0)

    loss, rows, _ = sum_partials(table.select("rows", "label", *layout.columns, "margin"), add, parts, 0)
    return [("train", "loss", loss / rows)] if rows else []


def _advance(
    table: DataFrame, layout: Layout, fresh: Weighted, without: Weighted, objective: str, nout: int, partitions: int,
    p: BoosterParams, seed: int, round_: int, cut: bool,
) -> tuple[DataFrame, list[tuple[float, float, float]]]:
    """The rows with ``fresh`` trees in their margins and the derivatives of the coming round; also the totals of these per output.

    Blocks carry their totals, so that adding them up is the pass that caches the rows. ``without`` takes out the trees that
    the round drops, for the derivatives only. Each tree is walked once per row and round, whatever the number of rounds and
    levels. Rows stay where they are; with ``cut`` they are checkpointed, so that the lineage stays short.
    """
    shipped = table.sparkSession.sparkContext.broadcast((fresh, without))
    kept, new = [c for c in table.columns if c not in ("margin", "g", "h", "totals")], ["margin", "g", "h", "totals"]

    def move(block: Block) -> dict[str, np.ndarray]:
        added, taken_out = shipped.value
        cells, label = layout.cells_of(block), block.values("label")
        margin = _added(block.matrix("margin"), cells, added, layout.raw)
        weight = np.where(label == 1, p.scale_pos_weight, 1.0)
        if p.subsample < 1.0:
            weight = weight * (block.items("drawn").to_numpy(zero_copy_only=False) < p.subsample)
        g, h = objectives.gradients(objective, _added(margin, cells, taken_out, layout.raw), label, weight)
        return {"margin": margin, "g": g, "h": h, "totals": totals_of(g, h)}

    def add(batches):
        total = np.zeros((nout, 3))
        for batch in batches:
            for held in batch.column("totals"):
                total += np.frombuffer(held.as_buffer()).reshape(nout, 3)
        return 0.0, 0.0, total.ravel()

    drawn = [F.transform("row_ids", lambda r: draw_column(seed, round_, r)).alias("drawn")] if p.subsample < 1.0 else []
    moved = map_blocks(table.select(*kept, "margin", *drawn), kept, new, move)
    moved = (reliable_checkpoint(moved) if cut else moved).persist(StorageLevel.MEMORY_AND_DISK)
    _, _, total = sum_partials(moved.select("totals"), add, partitions, 3 * nout)
    table.unpersist()
    return moved, [tuple(t) for t in total.reshape(nout, 3)]
