"""The Jaccard join against a comparison of all pairs."""

import random

import numpy as np
import pytest
from helpers import AWKWARD, AWKWARD_IDS, DOCS, component_rows, documents, sentence

from gradloom.llm import jaccard
from gradloom.llm.jaccard import Index, boundary, components, crossing_pairs, link_components, linked_pairs, overlaps


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def corpus(seed=0):
    rng, texts = random.Random(seed), list(AWKWARD)
    for size in (5, 9, 10, 12, 19, 21, 22, 25, 40, 90, 200):
        base = sentence(size, 100 + size)
        texts += [base, base.upper(), base + " tail", "head " + base]
        texts += [edited(rng, base, k) for k in (1, 1, 2, 3, 6) for _ in range(3)]
    passage = sentence(50, 7)
    texts += [f"{sentence(30, 1000 + i)} {passage}" for i in range(40)]
    return texts


@pytest.mark.parametrize("shipped", [0, 1_000_000])
def test_components_equal_all_pairs(spark, monkeypatch, shipped):
    monkeypatch.setattr(jaccard, "SHIPPED_ROWS", shipped)
    texts = corpus()
    ids = AWKWARD_IDS + list(range(100, 100 + len(texts) - len(AWKWARD)))
    found = link_components(documents(spark, texts, ids).repartition(4)).collect()
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, found)) == order(component_rows(list(zip(ids, texts))))


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SETS", 16)
    rng = random.Random(3)
    base = sentence(60, 5)
    texts = [edited(rng, base, k % 5) for k in range(150)]
    found = link_components(documents(spark, texts)).collect()
    assert sorted(map(tuple, found)) == sorted(component_rows(list(enumerate(texts))))


def test_many_copies_are_one_class(spark):
    texts = [sentence(50, 1)] * 500 + [sentence(50, 2)]
    found = {(r["doc_id"], r["component_id"]) for r in link_components(documents(spark, texts)).collect()}
    assert found == {(i, 0) for i in range(500)} | {(500, 500)}


def test_empty_and_wordless_tables(spark):
    assert link_components(spark.createDataFrame([], DOCS)).collect() == []
    rows = link_components(documents(spark, ["", None, " "])).collect()
    assert sorted(map(tuple, rows)) == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("size", [9, 10, 17, 18, 19, 20, 21, 27, 28, 60, 300])
def test_linked_sets_share_a_key(size):
    """For every way to part a threshold-wide difference, both sides of the boundary and of levels included."""
    index, rng = Index(90), np.random.default_rng(size)
    for added in range(size // 9 + 2):
        for removed in range(size // 9 + 2):
            if removed > size:
                continue
            shared = size - removed
            if 100 * shared < 90 * (size + added):
                continue
            for _ in range(10):
                items = rng.integers(0, 2**64, size + added, dtype=np.uint64)
                a, b = np.sort(items[:size]), np.sort(items[removed:])
                assert np.intersect1d(index.keys(a), index.keys(b)).size, (size, added, removed)


def test_boundary_follows_the_cost():
    assert boundary(90, 1) < boundary(90, 4) <= boundary(90, 1000)
    assert boundary(90) == 19


def test_group_comparisons_equal_plain_ones():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 30, n).astype(np.uint64)) for n in rng.integers(1, 40, 60)]
    plain = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert overlaps(sets, sets).tolist() == plain
    apart = [np.array([1], np.uint64), np.array([2], np.uint64)]
    assert overlaps(apart[:1], apart[1:]).tolist() == [[0]]
    few = linked_pairs(list(range(5)), sets[:5], 50)
    assert len(few) <= 4
    assert crossing_pairs(([], []), ([1], sets[:1]), 50) == []


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {(r["node"], r["comp"]) for r in found} == {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)}
