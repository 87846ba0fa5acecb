"""Seeded hashes: the same row gets the same draw under any partitioning."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_md5(seed: int, row_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def hash_thousandth(seed: int, row_id: Column) -> Column:
    """Bucket 0..999 of a row, taken from the leading 32 bits of its seeded md5."""
    head = F.conv(F.substring(seeded_md5(seed, row_id), 1, 8), 16, 10)
    return head.cast("bigint") % F.lit(1000).cast("bigint")


def draw(*parts) -> float:
    """A number in [0, 1) from the leading 32 bits of the md5 of the parts, joined by colons."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2.0**32


def draw_column(*parts) -> Column:
    """``draw`` as a column expression; columns among the parts are read as text."""
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    head = F.substring(F.md5(F.concat_ws(":", *texts)), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(2.0**32)


def uniform_draws(seed: int, stream: int, row_ids: np.ndarray, width: int) -> np.ndarray:
    """``[rows, width]`` uniforms in [0, 1) that depend on (seed, stream, row, column) only.

    The mixing steps are the published splitmix64 finaliser, applied to whole arrays.
    """
    with np.errstate(over="ignore"):
        base = np.uint64((seed * 1_000_003 + stream) & 0xFFFFFFFFFFFFFFFF)
        rows = _mix(row_ids.astype(np.int64).view(np.uint64) + _mix(np.full(1, base)))
        cols = np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = _mix(rows[:, None] + cols[None, :])
    return (mixed >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _mix(z: np.ndarray) -> np.ndarray:
    z = z + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))
