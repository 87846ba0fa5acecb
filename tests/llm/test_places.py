"""Sharding, archives and nearest neighbours."""

import gzip
import hashlib
import math
import random
import struct
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, AWKWARD_IDS, DOCS, documents
from pyspark.sql import functions as F

from gradloom.llm import neighbours, warc
from gradloom.llm.numbering import number_in_groups
from gradloom.llm.sharding import shard_rows, shard_tree


def plain_shard(tree, key):
    """The same descent in plain Python."""
    node = tree
    while node.children:
        def score(child):
            h = 42
            for value, kind in ((key, "<q"), (child.name, "<q"), (0, "<q")):
                h = xxhash.xxh64_intdigest(struct.pack(kind, value), seed=h)
            return math.log(((h >> 11) + 0.5) * 2.0**-53) / child.weight

        node = max((c for c in node.children if c.weight > 0), key=score)
    return node.name - 3_000_000_000


def test_shards_equal_a_plain_descent(spark):
    tree = shard_tree(8, weights={3: 2.5, 6: 0.0})
    rows = shard_rows(spark.range(3000).withColumn("shard", F.lit("old")), "id", tree).collect()
    assert all(r["shard"] == plain_shard(tree, r["id"]) for r in rows)
    assert {r["shard"] for r in rows} == {0, 1, 2, 3, 4, 5, 7}


def test_growth_and_weights_move_rows_only_where_they_must(spark):
    before, grown, heavy = shard_tree(8), shard_tree(8, added=1), shard_tree(8, weights={5: 3.0})
    rows = spark.range(20_000).select("id")
    for name, tree in (("a", before), ("b", grown), ("c", heavy)):
        rows = shard_rows(rows, "id", tree, name)
    rows = rows.collect()
    moved = [r for r in rows if r["a"] != r["b"]]
    assert {r["b"] for r in moved} == {8} and abs(len(moved) / len(rows) - 1 / 9) < 0.01
    # Shard 5 weighs more, and so do its rack and region: rows move into these subtrees, and at each level only there.
    for r in rows:
        if r["a"] != r["c"]:
            assert r["c"] >= 4
            assert r["a"] < 4 or r["c"] // 2 == 2
            assert r["a"] != 4 or r["c"] == 5
    assert abs(sum(r["c"] == 5 for r in rows) / len(rows) - 3 / 10) < 0.02


def test_slots_are_gapless_in_hot_groups(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).cast("int").alias("g")).repartition(9)
    found = {}
    for r in number_in_groups(rows, "g", "slot").collect():
        found.setdefault(r["g"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in found.values()) and sum(map(len, found.values())) == 5000
    assert number_in_groups(rows.limit(0), "g", "slot").collect() == []


def test_shard_query_over_awkward_documents(spark, tmp_path):
    from gradloom.llm.queries import op1_weighted_hash_tree

    documents(spark, AWKWARD, AWKWARD_IDS).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op1_weighted_hash_tree(spark, str(tmp_path)).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(AWKWARD_IDS, AWKWARD))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in rows) == want
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op1_weighted_hash_tree(spark, f"{tmp_path}/none").collect() == []


PAGES = "page_id bigint, url string, html string"


def plain_records(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(page, first.get(body, page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        again = body in first and page != first[body]
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    return sorted(out, key=str)


def test_archives_read_back_whole(spark, tmp_path):
    noise = random.Random(0)
    rows = [
        (3, "http://a/%\r\nb", "x" * 100), (1, "http://b", "x" * 100), (2, None, "x" * 100), (4, "http://c", "y" * 99),
        (5, "http://d", "y" * 99), (6, "http://e", None), (7, "http://e", ""), (None, "http://f", "x" * 100),
        (8, "http://g", "\r\n\r\nWARC/1.1\r\n\r\né漢\U0001f600" * 20), (9, "http://h", "\x00\x1f\x8b\x08" * 50),
        (1, "http://b", "x" * 100), (10, "http://i", "".join(noise.choice("abcdefgh") for _ in range(300_000))),
    ]
    frame = spark.createDataFrame(rows, PAGES).repartition(3)
    warc.write_warc(warc.mark_revisits(frame), f"{tmp_path}/w")
    files = list(Path(tmp_path, "w").glob("part-*"))
    assert sum(gzip.decompress(f.read_bytes()).count(b"WARC-Type: ") for f in files) == len(rows)
    found = warc.read_warc(spark, f"{tmp_path}/w").collect()
    told = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(told, key=str) == plain_records(rows)
    assert {r["url"] for r in found} == {u for _, u, _ in rows}
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in found if r["payload"] is not None)
    warc.write_warc(warc.mark_revisits(frame.limit(0)), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").collect() == []


def test_members_end_in_the_byte_that_ends_lines():
    row = {"page_id": 1, "url": "u", "digest": "d", "record_type": "response", "refers_to": None, "payload": b"z" * (17 << 20)}
    packed = warc._member(row, 1) + b"\0"
    assert gzip.decompress(packed) == warc._record(row)


def test_chance_magic_at_any_border_loses_no_record(spark, tmp_path):
    """Archives whose compressed bytes hold gzip magic themselves, cut at every place."""
    def stored(page, body):
        row = {"page_id": page, "url": "u", "digest": hashlib.sha256(body).hexdigest(), "record_type": "response", "refers_to": None, "payload": body}
        return warc._gzip(warc._record(row), 0)  # stored bytes, so a payload's magic stays as it is

    inner = warc._gzip(b"nothing of ours", 9)
    bodies = [b"start" + warc.MAGIC * 3 + b"x" * 40 + inner, b"plain", inner * 4, warc.MAGIC]
    Path(tmp_path, "a").mkdir()
    Path(tmp_path, "a", "part-0").write_bytes(b"".join(stored(i, b) for i, b in enumerate(bodies)))
    want = sorted((i, hashlib.sha256(b).hexdigest()) for i, b in enumerate(bodies))
    for size in (90, 137, 400, 100_000):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        spark.conf.set("spark.sql.files.minPartitionNum", 1)
        try:
            found = warc.read_warc(spark, f"{tmp_path}/a").collect()
        finally:
            for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
                spark.conf.unset(f"spark.sql.files.{name}")
        assert sorted((r["page_id"], r["payload_digest"]) for r in found) == want, size


def test_archives_inside_of_payloads_are_not_taken_apart(spark, tmp_path, monkeypatch):
    """A payload that is an archive itself, longer than many ranges, with another one inside, cut at every place."""

    def record(page, body, level):
        row = {"page_id": page, "url": "u", "digest": hashlib.sha256(body).hexdigest(), "record_type": "response", "refers_to": None, "payload": body}
        return warc._gzip(warc._record(row), level)

    nested = b"".join(record(99, bytes([65 + i]) * 30, 9) for i in range(3))
    deeper = record(98, nested + b"tail", 0) + nested
    bodies = [b"first", nested, b"between" * 9, deeper + nested[:150], b"last"]
    monkeypatch.setattr(warc, "REDONE_FILES", 1)
    for name, files in (("one", [bodies]), ("two", [bodies[:2], bodies[3:]])):
        Path(tmp_path, name).mkdir()
        want = []
        for k, held in enumerate(files):
            Path(tmp_path, name, f"part-{k}").write_bytes(b"".join(record(10 * k + i, b, 0) for i, b in enumerate(held)))
            want += [(10 * k + i, hashlib.sha256(b).hexdigest()) for i, b in enumerate(held)]
        for size in (400, 1500) if name == "one" else (700,):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            spark.conf.set("spark.sql.files.minPartitionNum", 1)
            try:
                found = warc.read_warc(spark, f"{tmp_path}/{name}").collect()
            finally:
                for conf in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
                    spark.conf.unset(f"spark.sql.files.{conf}")
            assert sorted((r["page_id"], r["payload_digest"]) for r in found) == sorted(want), (name, size)


VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain_neighbours(rows, asked, k=5):
    held = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        held.setdefault(i, []).append(np.array(v, np.float64))
    out = []
    for i in sorted(held):
        if asked(i):
            for q in held[i][:1]:
                best = sorted((-float(np.dot(q, v) / math.sqrt(q @ q) / math.sqrt(v @ v)), j) for j, vs in held.items() if j != i for v in vs[:1])
                out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best[:k])]
    return out


def test_neighbours_of_awkward_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, [1.0, 2.0, 0.0, 0.0, 0.0, -0.0]) for i in range(200)]
    rows += [(500, None), (501, [0.0] * 6), (502, [float("nan")] + [1.0] * 5), (503, [None] + [1.0] * 5), (504, [float("inf")] * 6), (None, [1.0] * 6)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(5)
    found = neighbours.nearest_neighbours(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    want = plain_neighbours(rows, lambda i: i % 50 == 0)
    assert [tuple(r)[:3] for r in found] == [w[:3] for w in want]
    assert np.allclose([r["score"] for r in found], [w[3] for w in want], rtol=0, atol=1e-12)


def test_few_vectors_give_all_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [2.0, 0.0], 0)], VECTORS)
    found = neighbours.nearest_neighbours(frame, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in found] == [(1, 2), (2, 1)]
    assert neighbours.nearest_neighbours(frame.limit(1), F.col("vec_id") == 0).collect() == []
    assert neighbours.nearest_neighbours(frame.limit(0), F.col("vec_id") == 0).collect() == []


def test_cells_are_visited_by_summed_distance():
    rng = np.random.default_rng(2)
    for _ in range(50):
        left, right = rng.normal(size=rng.integers(1, 9)), rng.normal(size=rng.integers(1, 9))
        counts = rng.integers(0, 4, (len(left), len(right)))
        wanted = int(rng.integers(1, counts.sum() + 2))
        sums = (left[:, None] + right[None, :]).ravel()
        order = np.argsort(sums, kind="stable")
        n = int(np.searchsorted(np.cumsum(counts.ravel()[order]), wanted)) + 1
        want = np.zeros(len(sums), bool)
        want[order[:n]] = True
        assert (neighbours.traverse(left, right, counts, wanted).ravel() == want).all()


@pytest.mark.parametrize("table", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf_dir, table, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    frame = spark.read.parquet(f"{sf_dir}/../{table}/embeddings.parquet")
    found = {}
    for r in neighbours.nearest_neighbours(frame, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    table = frame.toPandas().sort_values("vec_id")
    ids, v = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), np.float64)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[q]
        score[q] = -2
        hits += len(found[ids[q]] & set(ids[np.argsort(-score)[:5]].tolist()))
        total += 5
    assert hits / total >= 0.9
