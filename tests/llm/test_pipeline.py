"""The pipeline's stages, each against what a plain version leaves."""

import random

import numpy as np
import pytest
from helpers import AWKWARD, DOCS, component_rows, documents, measures, private_spans, sentence

import corpus_pipeline
from gradloom.llm import quality
from gradloom.llm.jaccard import Index


def write(spark, path, texts, ids=None):
    docs = documents(spark, texts, ids)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_every_stage_takes_effect(spark, tmp_path):
    base = sentence(60, 3)
    texts = AWKWARD + [base, base + " tail", base, "mail a@b.cd " + sentence(30, 4), "same words again " * 20]
    docs = write(spark, tmp_path, texts)
    plain = {}
    for i, text in enumerate(texts):
        n, _, _, _, repeated = measures(text)
        if n >= 10 and 100 * repeated <= 20 * n:
            plain[i] = text
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {r["doc_id"]: r["text"] for r in kept.collect()} == plain
    single = stages["near-duplicates"](spark, kept, str(tmp_path))
    wanted = {d for d, _, c in component_rows(sorted(plain.items())) if d == c}
    assert single.columns == docs.columns and {r["doc_id"] for r in single.collect()} == wanted
    clean = stages["personal data"](spark, single, str(tmp_path))
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert {r["doc_id"] for r in rows} == wanted
    assert not any(private_spans(r["text"]) for r in rows)
    packed = stages["packing"](spark, clean, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == wanted
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    digest = lambda rows: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert digest(whole) == digest(packed)


def test_rows_of_one_doc_id_are_one_document(spark, tmp_path):
    texts = [sentence(20, i) for i in (1, 1, 2, 3, 3)]
    docs = write(spark, tmp_path, texts, [1, 1, 1, 5, None])
    rows = corpus_pipeline.deduplicate(spark, docs, str(tmp_path)).collect()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["doc_id"])] == [1, 5]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_name_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "personal data", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and quality.CONTENT_SHARE == 0.5


def near_components(texts, width, percent):
    """The first of all that each text is linked with, by comparing all pairs."""
    sets = []
    for text in texts:
        words = text.lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))})
    above = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                low, high = sorted((above[i], above[j]))
                above = [low if x == high else x for x in above]
    return above


def test_near_duplicates_by_five_words_and_eighty_percent(spark, tmp_path):
    rng, texts = random.Random(5), []
    for k, size in enumerate((6, 9, 12, 14, 20, 33, 60, 100, 100, 250, 700, 2000)):
        base = sentence(size, 50 + k)
        texts.append(base)
        for edits in (1, 2, 4, 8, 20, 50):
            words = base.split()
            for at in rng.sample(range(size), min(edits, size // 10 + 1)):
                words[at] = f"new{rng.random()}"
            texts += [" ".join(words), base + " tail" * (edits % 5)]
    words = sentence(100, 99).split()
    changed = [w if i not in (30, 70) else "changed" for i, w in enumerate(words)]
    texts += [" ".join(words), " ".join(changed)]
    above = near_components(texts, 5, 80)
    assert above[-1] == len(texts) - 2 and near_components(texts[-2:], 3, 90) == [0, 1]
    rows = corpus_pipeline.deduplicate(spark, documents(spark, texts).repartition(3), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(set(above))


@pytest.mark.parametrize("percent", [80, 90])
def test_long_sets_list_no_empty_blocks(percent):
    index, rng = Index(percent), np.random.default_rng(percent)
    for size in (30, 100, 999, 20_000):
        for _ in range(5):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            b = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            near = np.sort(np.concatenate([a[size * (100 - percent) // (100 + percent) :], b[: size * (100 - percent) // (100 + percent)]]))
            assert not np.intersect1d(index.keys(a), index.keys(b)).size
            assert np.intersect1d(index.keys(a), index.keys(near)).size


def test_rows_go_only_for_copies_of_their_own(spark, tmp_path):
    a, b, c, d, e, f = (sentence(30, 200 + i) for i in range(6))
    rows = [
        (1, a), (None, a), (None, b),  # a copy and a unique text, both without a doc_id
        (2, c), (3, c + " tail"), (3, d), (9, d),  # one of the texts of 3 is a copy, the other one is not
        (4, e), (4, e + " tail"), (4, f), (8, f + " tail"),  # 4 comes first in two components
        (None, "x " + sentence(30, 210)), (None, sentence(30, 210)), (None, sentence(30, 210)),  # near copies, none with a doc_id
        (None, ""), (None, None), (5, ""), (6, ""), (6, ""),
    ]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(3)
    left = corpus_pipeline.deduplicate(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in left.collect()]
    ids = [i for i, _ in left if i is not None]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6, 8] or sorted(ids) == [1, 2, 3, 4, 5, 6]
    assert (1, a) in left and (2, c) in left and (3, d) in left
    without = [t for i, t in left if i is None]
    assert b in without and a not in without and without.count("") == without.count(None) == 1 and len(without) == 4
    assert sum(sentence(30, 210) in (t or "") for t in without) == 1
    four = next(t for i, t in left if i == 4)
    assert (four[: len(e)] == e and (8, f + " tail") in left) or (four == f and 8 not in ids)
