"""Who meets whom on inverted lists, and which of them could link: groups of any size, compared in blocks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradloom.llm.batches import map_arrow
from gradloom.session import reliable_checkpoint

# Sketches that one task compares with each other; a larger group is compared block by block.
BLOCK_SKETCHES = 2048
# Pairs looked at together inside a task.
HELD_PAIRS = 1 << 19


class Screen(Protocol):
    """Which pairs may link."""

    def prepare(self, sizes: np.ndarray, sketches: list[bytes]):
        """Sets made ready to be compared."""

    def may_link(self, ready, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the sets at ``left`` may link with those at ``right``, pair by pair."""


def gathered(entries: DataFrame) -> DataFrame:
    """(center, node) rows from (key, node) ones: all nodes of a list under the smallest of them.

    Lists are never gathered. Their lengths and centers are one aggregate, combined in map tasks first; only lists of two or
    more are joined back, and a list that a third of all nodes are on is split by the join as any skewed key.
    """
    lists = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("center")).where("n > 1")
    return entries.join(lists.select("key", "center"), "key").select("center", "node").distinct()


def cell_pairs(first: np.ndarray, last: np.ndarray, split: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of cells of rows first .. last - 1, some ``HELD_PAIRS`` at a time.

    A cell of two blocks pairs the rows before ``split`` with the others, one of a single block (split = first) all of
    its rows with each other.
    """
    held, size = [], 0
    for low, high, cut in zip(first.tolist(), last.tolist(), split.tolist()):
        for row in range(low, cut if cut > low else high):
            partners = (max(row + 1, cut), high)
            if partners[0] < high:
                held.append((row, *partners))
                size += high - partners[0]
            if size >= HELD_PAIRS:
                yield _spread(held)
                held, size = [], 0
    if held:
        yield _spread(held)


def _spread(runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    row, low, high = np.array(runs).T
    lengths = high - low
    left = np.repeat(row, lengths)
    right = np.arange(len(left)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(low, lengths)
    return left, right


def screened(members: DataFrame, sketches: DataFrame, screen: Screen) -> DataFrame:
    """The (center, node) rows of nodes that ``screen`` lets link with another one of their group.

    ``sketches`` has node, size and sketch (binary, small). Groups beyond ``BLOCK_SKETCHES`` are cut into blocks by a hash of
    the node and every pair of blocks is a task's work; what is copied is sketches, never sets. Centers that meet nobody
    else are dropped first.
    """
    sized = members.groupBy("center").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / BLOCK_SKETCHES).cast("int").alias("parts")
    rows = members.join(sized.select("center", parts), "center").join(sketches, "node")
    block = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = rows.withColumn("block", block).withColumn("other", F.explode(other)).select(
        "center", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "size", "sketch"
    )

    def compare(batches):
        carry = None
        for batch in batches:  # sorted by center, low, high, block
            table = pa.Table.from_batches([batch] if carry is None else [*carry.to_batches(), batch])
            starts = _starts(table)
            yield from cells(table.slice(0, starts[-1]), starts[:-1])
            carry = table.slice(starts[-1])  # its rows may go on in the next batch
        if carry is not None:
            yield from cells(carry, np.array([0]))

    def cells(table: pa.Table, starts: np.ndarray):
        if not table.num_rows:
            return
        center, block, low, high, node, size = (table.column(c).to_numpy() for c in ("center", "block", "low", "high", "node", "size"))
        ends = np.r_[starts[1:], table.num_rows]
        first_block = np.add.reduceat(block == low, starts)
        split = np.where(low[starts] == high[starts], starts, starts + first_block)
        ready, met = screen.prepare(size, table.column("sketch").to_pylist()), np.zeros(len(node), bool)
        whole = (ends - starts > 1) & ((low[starts] == high[starts]) | (split < ends) & (split > starts))
        for left, right in cell_pairs(starts[whole], ends[whole], split[whole]):
            good = screen.may_link(ready, left, right)
            met[left[good]] = True
            met[right[good]] = True
        if met.any():
            yield pa.RecordBatch.from_pydict({"center": center[met], "node": node[met]})

    order = ["center", "low", "high", "block"]
    met = dealt.repartition("center", "low", "high").sortWithinPartitions(*order)
    return map_arrow(met, compare, "center bigint, node bigint").distinct()


def _starts(table: pa.Table) -> np.ndarray:
    """Where a cell's rows begin."""
    keys = np.stack([table.column(c).to_numpy() for c in ("center", "low", "high")], axis=1)
    return np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])


def screened_members(entries: DataFrame, sketches: DataFrame, screen: Screen) -> DataFrame:
    """Checkpointed (center, node) rows worth an exact comparison."""
    return reliable_checkpoint(screened(reliable_checkpoint(gathered(entries)), sketches, screen))
