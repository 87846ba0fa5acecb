"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, DOCS, LOWER

from gradloom.llm import phrases
from gradloom.llm.phrases import Coder, collocations, merged, subtree


def plain(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, held in counts.items():
        found = {p: f for p, f in held.items() if len(p) > 1 and f >= least}
        around = Counter()
        for p, f in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i : i + k]] = max(around[p[i : i + k]], f)
        ranked = []
        for p, a in found.items():
            cuts = [(2_000_000 * a // (held[p[:k]] + held[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if not 100 * around[p] >= 80 * a:
                ranked.append((-score, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed=0):
    rng, rows = random.Random(seed), [("en", t) for t in AWKWARD]
    common = ["the", "of", "New", "york", "city", "é", "漢字", "a b", "in"]
    for k in range(120):
        words = [rng.choice(common) if rng.random() < 0.7 else f"w{rng.randrange(40)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["big apple pie now", "a. b", "x,\ty ;z", "la la la la la", "one\ntwo\x0bthree"]))
        rows.append((rng.choice(["en", "en", "en", "fr", None, ""]), " ".join(words)))
    return rows + [("fr", "hot hot phrase here") for _ in range(300)] + [("en", None), (None, None), ("de", "!!!")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)


@pytest.mark.parametrize(("budget", "listed", "held"), [(phrases.BUDGET, True, phrases.HELD_SUFFIXES), (64, True, 100), (64, False, 1000), (1, True, 50)])
def test_collocations_equal_a_plain_count(spark, monkeypatch, budget, listed, held):
    monkeypatch.setattr(phrases, "HELD_SUFFIXES", held)
    if not listed:
        monkeypatch.setattr(phrases, "BROADCAST_BYTES", 0)
    rows = corpus()
    found = collocations(table(spark, rows).repartition(5), least=3, top=50, budget=budget).collect()
    expected = plain(rows, 3, 50)
    assert len(expected) > 80
    assert sorted(map(tuple, found)) == expected


def test_partitions_keep_their_budget(spark):
    rows = table(spark, corpus())
    words = phrases.count_words(rows, 0)
    listed = np.sort(words.select("code").toArrow().column("code").to_numpy().view(np.uint64))
    coder = Coder(0, listed)
    edges = phrases.partition_edges(rows, phrases._coded(words, coder), coder, 64)
    assert (edges[0] == 0).all()
    batch = rows.where("text IS NOT NULL").selectExpr("coalesce(lang, 'und') AS lang", "text").toArrow().combine_chunks().to_batches()[0]
    suffixes = coder.suffixes(phrases.Pieces(batch, 0))
    leaves, counts = merged(suffixes, np.ones(len(suffixes), np.int64))
    at = np.r_[phrases._places(leaves, edges), len(leaves)]
    for low, high in zip(at, at[1:]):
        assert counts[low:high].sum() <= 64 or high - low == 1
    assert counts.sum() == len(suffixes)


def test_empty_wordless_and_clashing_tables(spark):
    assert collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations(table(spark, [("en", ""), (None, None), ("fr", " .,\n")])).collect() == []
    rows = table(spark, [("en", "a b")] * 3)
    for name in ("word", "code", "f", "part", "n", "rank"):
        rows = rows.selectExpr("*", f"doc_id AS {name}")
    found = [tuple(r) for r in collocations(rows, least=2).collect()]
    assert found == [("en", 1, "a b", 3, 3, 3, 6, 1_000_000)]


def test_other_hashes_are_used_after_a_collision(spark, monkeypatch):
    clash = phrases.Pieces.__init__

    def clashing(self, batch, seed):
        clash(self, batch, seed)
        if not seed:
            self.hashes = self.hashes & np.uint64(3) | np.uint64(1)

    monkeypatch.setattr(phrases.Pieces, "__init__", clashing)
    rows = [("en", "a b c d e f a b")] * 4
    batch = table(spark, rows).selectExpr("lang", "text").toArrow().combine_chunks().to_batches()[0]
    assert len(set(phrases.Pieces(batch, 0).hashes.tolist())) < 6 == len(set(phrases.Pieces(batch, 1).hashes.tolist()))


def test_subtrees_read_counts_from_leaves():
    leaves = np.array([[1, 2, 0, 0], [1, 2, 3, 0], [1, 2, 3, 4], [1, 5, 0, 0]], np.uint32)
    counts = np.array([1, 2, 4, 3])
    nodes = {tuple(n): t for node, totals in subtree(leaves, counts, 3, None, None) for n, t in zip(node.tolist(), totals.tolist())}
    assert nodes == {(1, 2, 0, 0): 7, (1, 5, 0, 0): 3, (1, 2, 3, 0): 6, (1, 2, 3, 4): 4}
