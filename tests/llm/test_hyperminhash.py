"""Registers, estimates and components against plain versions."""

import random

import numpy as np
import pytest
from helpers import AWKWARD, AWKWARD_IDS, DOCS, component_rows, documents, sentence
from test_jaccard import edited

from gradloom.llm import hyperminhash, jaccard, meeting
from gradloom.llm.hyperminhash import REGISTERS, band_keys, chance, estimates, near_duplicates, registers


def corpus(seed=0):
    rng, texts = random.Random(seed), list(AWKWARD)
    for size in (4, 5, 8, 12, 20, 40, 90, 300, 1500):
        base = sentence(size, 100 + size)
        texts += [base, base.upper(), base + " tail", "head " + base]
        texts += [edited(rng, base, k) for k in (1, 1, 2, 3, size // 25, size // 20, size // 15) for _ in range(2)]
    passage = sentence(50, 7)
    texts += [f"{sentence(30, 1000 + i)} {passage}" for i in range(40)]
    return texts


def plain_registers(items):
    out = []
    for bucket in range(REGISTERS):
        held = [int(i) & ((1 << 57) - 1) for i in items if int(i) >> 57 == bucket]
        if not held:
            out.append(None)
            continue
        bits = f"{min(held) >> 4:053b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        behind = bits[zeros + 1 : zeros + 11].ljust(10, "0")
        out.append((zeros + 1 << 10) | int(behind, 2))
    return out


def expected(ids, texts):
    return [(d, n, c, d == c) for d, n, c in component_rows(list(zip(ids, texts)), 80, 4)]


@pytest.mark.parametrize("shipped", [0, 1_000_000])
def test_components_equal_all_pairs(spark, monkeypatch, shipped):
    monkeypatch.setattr(jaccard, "SHIPPED_ROWS", shipped)
    texts = corpus()
    ids = AWKWARD_IDS + list(range(100, 100 + len(texts) - len(AWKWARD)))
    found = near_duplicates(documents(spark, texts, ids).repartition(4)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected(ids, texts), key=str)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SETS", 16)
    monkeypatch.setattr(meeting, "BLOCK_SKETCHES", 16)
    rng = random.Random(3)
    base = sentence(120, 5)
    texts = [edited(rng, base, k % 7) for k in range(150)]
    found = near_duplicates(documents(spark, texts)).collect()
    assert sorted(map(tuple, found)) == sorted(expected(range(150), texts))


def test_empty_tables_and_clashing_columns(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    rows = documents(spark, ["", None, " ", "a b c d e", "A b c d e"])
    for name in ("node", "sketch", "key", "center", "text_key", "row"):
        rows = rows.selectExpr("*", f"doc_id AS {name}")
    found = sorted(map(tuple, near_duplicates(rows).collect()))
    assert found == [(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 2, 3, True), (4, 2, 3, False)]


@pytest.mark.parametrize("size", [1, 3, 100, 5000, 100_000])
def test_registers_are_zeros_and_mantissa(size):
    items = np.unique(np.random.default_rng(size).integers(0, 2**64, size, dtype=np.uint64))
    found, plain = registers(items).tolist(), plain_registers(items) if size <= 5000 else None
    if plain:
        assert [f for f, p in zip(found, plain) if p is not None] == [p for p in plain if p is not None]
        assert set(found) == {p for p in plain if p is not None}  # empty buckets borrow
    assert min(found) > 0
    assert registers(np.zeros(0, np.uint64)).tolist() == [0] * REGISTERS


@pytest.mark.parametrize(("size", "share"), [(20, 0.8), (200, 0.8), (3000, 0.5), (3000, 0.8), (3000, 0.0)])
def test_estimates_are_near_the_jaccard(size, share):
    rng, found = np.random.default_rng(size), []
    for _ in range(60):
        items = rng.integers(0, 2**64, 2 * size, dtype=np.uint64)
        both = int(2 * size * share / (1 + share))
        a, b = np.sort(items[: (size + both // 2)]), np.sort(items[size - both + both // 2 :])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        equal = np.array([(registers(a) == registers(b)).sum()])
        found.append(estimates(equal, np.array([len(a)]), np.array([len(b)]))[0] - true)
    assert abs(np.mean(found)) < 0.02 and np.std(found) < 0.06


def test_chance_is_what_unlike_sets_share():
    rng = np.random.default_rng(5)
    for size in (64, 2000):
        tables = np.stack([registers(np.sort(rng.integers(0, 2**64, size, dtype=np.uint64))) for _ in range(400)])
        equal = np.mean([(tables[:-k] == tables[k:]).mean() for k in range(1, 100)])
        assert 0.5 < equal / chance(np.array([size]))[0] < 2.0


@pytest.mark.parametrize("size", [1, 4, 5, 9, 10, 27, 100, 1000])
def test_linked_sets_share_a_band_and_pass_the_screen(size):
    rng, screen = np.random.default_rng(size), hyperminhash.EstimateScreen(80)
    for _ in range(300):
        removed = rng.integers(0, size // 5 + 1)
        added = (size - removed) * 5 // 4 - size
        items = rng.integers(0, 2**64, size + max(added, 0), dtype=np.uint64)
        a, b = np.sort(items[:size]), np.sort(items[removed:])
        assert 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
        table = np.stack([registers(a), registers(b)])
        keys = band_keys(table)
        assert (keys[0] == keys[1]).any()
        ready = screen.prepare(np.array([len(a), len(b)]), [t.tobytes() for t in table])
        assert screen.may_link(ready, np.array([0]), np.array([1])).all()
