"""Packing and sampled segmentations."""

import functools
import zlib

import numpy as np
import pytest
from helpers import AWKWARD, AWKWARD_IDS, DOCS, documents, sentence

from gradloom.llm import packing, pieces
from gradloom.llm.packing import Slots, is_plain, pack_pieces, packed_documents, plain_encoder, shortest_pack_first, token_ids


@functools.lru_cache(maxsize=1)
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids(text):
    return reference().encode(text, add_special_tokens=False).ids


def check_packing(rows, texts, limit):
    """Pieces cut each document's ids without gaps; sequences are filled without gaps up to the limit."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids, at = reference_ids(text or "") + [0], 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limit
        padding += limit - at
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return padding


def test_awkward_documents_pack_whole(spark):
    texts = {i: t for i, t in enumerate(AWKWARD)}
    rows = packed_documents(documents(spark, AWKWARD)).collect()
    check_packing(rows, texts, 1024)


def test_many_short_documents_leave_little_padding(spark):
    texts = [sentence(3 + i * 7 % 150, i) for i in range(400)] + [sentence(9, 1)] * 300
    rows = packed_documents(documents(spark, texts).repartition(5)).collect()
    padding = check_packing(rows, dict(enumerate(texts)), 1024)
    assert padding < 0.02 * 1024 * len({r["sequence_id"] for r in rows})


def test_pack_keeps_repeated_rows_and_extra_columns(spark):
    rows = spark.createDataFrame([(5, "a", 1, 2)] * 3 + [(7, None, 0, 0)], "length int, note string, offset int, _group int")
    packed = pack_pieces(rows, limit=10).orderBy("sequence_id", "offset").collect()
    assert [(r["length"], r["note"], r["offset"]) for r in packed] == [(7, None, 0), (5, "a", 0), (5, "a", 5), (5, "a", 0)]
    assert pack_pieces(rows.limit(0), limit=10).count() == 0
    with pytest.raises(Exception, match="piece lengths"):
        pack_pieces(rows, limit=6).collect()


def test_empty_table(spark):
    assert packed_documents(spark.createDataFrame([], DOCS)).collect() == []
    assert pieces.round_trip(spark.createDataFrame([], DOCS)).collect() == []


def test_shortest_pack_first_follows_the_method():
    assert shortest_pack_first({6: 2, 4: 3, 1: 1}, 10) == [([6, 4], 2), ([4, 1], 1)]
    assert shortest_pack_first({3: 7}, 10) == [([3, 3, 3], 2), ([3], 1)]
    lengths = {n: 1 + n * 37 % 11 for n in range(1, 64)}
    patterns = shortest_pack_first(lengths, 64)
    placed = {}
    for pattern, count in patterns:
        assert sum(pattern) <= 64
        for n in pattern:
            placed[n] = placed.get(n, 0) + count
    assert placed == lengths
    slots = Slots(patterns)
    spans = set()
    for n, count in lengths.items():
        for s, o in zip(*slots.place(np.full(count, n), np.arange(count), 64)):
            new = {(s, o + k) for k in range(n)}
            assert not spans & new
            spans |= new


def test_both_tokenizers_agree_on_every_plain_character():
    for c in range(packing.PLAIN_LIMIT):
        for text in (f"a{chr(c)}b", f"1{chr(c)} {chr(c)}{chr(c)} 2", f" {chr(c)}'s\n{chr(c)}", f"{chr(c)}  {chr(c)}."):
            assert is_plain(text)
            assert token_ids(text).tolist() == reference_ids(text), (c, text)
    for text in ("漢字 \U0001f600 x", "<|endoftext|> a", "x" * 5000 + " y"):
        assert token_ids(text).tolist() == plain_encoder().encode(text, add_special_tokens=False).ids


def test_segmentations_are_lossless_and_reproducible(spark):
    docs = documents(spark, AWKWARD, AWKWARD_IDS)
    rows = pieces.decode_pieces(pieces.sample_pieces(docs, "doc_id")).select("text", "decoded", "pieces").collect()
    assert all((r["text"] or "") == r["decoded"] for r in rows)
    again = pieces.sample_pieces(docs.repartition(3), "doc_id").select("text", "pieces").collect()
    assert sorted((r["text"] or "", r["pieces"]) for r in rows) == sorted((r["text"] or "", r["pieces"]) for r in again)
    prose = documents(spark, ["this thing there with another information nation " * 50] * 2)
    drawn = [tuple(r["pieces"]) for seed in (0, 1) for r in pieces.sample_pieces(prose, "doc_id", seed=seed).select("pieces").collect()]
    assert len(set(drawn)) == 4
    told = pieces.round_trip(docs).collect()
    assert len(told) == len(AWKWARD) and all(r["lossless"] for r in told)


def every_segmentation(text, book):
    """All ways to write a text in pieces, and the product of weights of each."""
    if not text:
        return {(): 1.0}
    out = {}
    for n in range(1, len(text) + 1):
        piece = book.get(text[:n])
        if piece is not None or n == 1:
            number, weight = piece if piece else (None, np.exp(pieces.UNKNOWN_WEIGHT))
            for rest, w in every_segmentation(text[n:], book).items():
                out[(number, *rest)] = weight * w
    return out


def test_draws_follow_the_product_of_weights():
    import public_tokenizers
    import sentencepiece

    lattice = pieces.lattice()
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    book = {model.id_to_piece(i): (i, float(np.exp(lattice.weight[i]))) for i in range(259, model.get_piece_size())}
    wanted = every_segmentation("▁thin", book)
    total = sum(wanted.values())
    n = 20_000
    ids, bounds = pieces.encode(["thin"] * n, np.arange(n), lattice)
    found = {}
    for a, b in zip(bounds, bounds[1:]):
        found[tuple(ids[a:b])] = found.get(tuple(ids[a:b]), 0) + 1
    assert set(found) <= set(wanted)
    for way, weight in wanted.items():
        p = weight / total
        assert abs(found.get(way, 0) / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4


def test_unequal_words_of_one_hash_stay_apart(monkeypatch):
    texts = ["abc abd abc", "xyz"]
    want, bounds = pieces.encode(texts, np.arange(2), pieces.lattice())
    real = pieces.mix
    monkeypatch.setattr(pieces, "mix", lambda z: real(z) & np.uint64(0) if z.shape != (2,) and z.dtype == np.uint64 else real(z))
    kind, first = pieces._distinct(np.array([1, 2, 1, 3, 1, 2]), np.array([0, 2, 4]), np.array([2, 2, 2]))
    assert kind[0] != kind[1] and len(first) >= 2


def test_added_tokens_in_a_text_are_one_id(spark):
    texts = ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b", "<|endoftext |> <|ENDOFTEXT|>", "é漢<|endoftext|>"]
    assert reference_ids(texts[0]) == [437, 220, 50256, 1306] == token_ids(texts[0]).tolist()
    for text in texts:
        assert token_ids(text).tolist() == reference_ids(text)
    check_packing(packed_documents(documents(spark, texts)).collect(), dict(enumerate(texts)), 1024)
