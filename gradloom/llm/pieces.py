"""SentencePiece encoding by forward filtering and backward sampling over the piece lattice, and lossless decoding."""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.llm.batches import map_arrow
from gradloom.llm.kernels import Texts, mix, sequence, slices

MODEL = "piece_bpe_32k.model"
# The mark that stands for a space, and the code that stands for a mark in the text itself.
MARK, ESCAPED_MARK = 0x2581, 0x110000
# A file of merges holds ranks, not probabilities: a piece of rank r gets the weight 1 / (r + RANK_SHIFT).
RANK_SHIFT = 10.0
# Log weight of a character that is no piece and is written as bytes.
UNKNOWN_WEIGHT = -20.0
# Text bytes that are encoded at once.
ENCODE_BYTES = 2 * 1024 * 1024
UNSET, UNKNOWN = -1, -2
PLACES = sequence(1 << 50, 4096) | np.uint64(1)


class Lattice:
    """The pieces of a model as a trie in sorted arrays, their weights and their bytes."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        texts = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(size)]
        if any("▁" in t.lstrip("▁") for t, s in zip(texts, special) if not s):
            raise ValueError("a piece of this model runs over a word border")
        self.weight = np.array([-np.log(min(-model.get_score(i), size) + RANK_SHIFT) for i in range(size)])
        edges: dict[tuple[int, int], int] = {}
        piece_at = {}
        for i, text in enumerate(texts):
            if special[i] or not text:
                continue
            node = 0
            for c in map(ord, text):
                node = edges.setdefault((node, c), len(edges) + 1)
            piece_at.setdefault(node, i)
        keys = np.array([(n << 21) | c for n, c in edges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array(list(edges.values()), dtype=np.int64)[order]
        self.piece = np.full(len(edges) + 1, UNSET, dtype=np.int64)
        self.piece[list(piece_at)] = list(piece_at.values())
        self.first = np.full(0x110001, -1, dtype=np.int32)
        for (node, c), child in edges.items():
            if node == 0:
                self.first[c] = child
        # Characters inside of some piece; any other one stands alone in every segmentation.
        self.known = np.zeros(0x110001, dtype=bool)
        self.known[[c for _, c in edges]] = True
        raw = [t.replace("▁", " ").encode() for t in texts]
        for b, i in enumerate(self.byte_ids.tolist()):
            raw[i] = bytes([b])
        self.bytes_of = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.length = np.array([len(r) for r in raw], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Child of each node by a character, or -1."""
        wanted = (nodes << 21) | chars
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.child[at], -1)


@functools.lru_cache(maxsize=2)
def lattice(model: str = MODEL) -> Lattice:
    import public_tokenizers

    return Lattice(public_tokenizers.path(model))


def encode(texts: list[str], keys: np.ndarray, pieces: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, one after another, and the bounds of each text.

    A segmentation is drawn with a probability in proportion to the product of its pieces' weights. Every draw is a
    hash of the text's key and the place in the text, so it does not depend on what else is in the batch. Words and
    characters that no piece holds cut the lattice, and equal words share one: it is filtered forward once, and all of its
    occurrences are sampled backward together.
    """
    counts = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    heads = np.cumsum(counts) - counts
    raw = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    total = len(raw)
    if not total:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    chars = raw.copy()
    chars[raw == 0x20] = MARK
    chars[raw == MARK] = ESCAPED_MARK
    row = np.repeat(np.arange(len(texts)), counts)

    known = pieces.known[chars]
    begins = ~known
    begins[1:] |= ~known[:-1]
    begins[1:] |= (chars[1:] == MARK) & (chars[:-1] != MARK)
    begins[heads[counts > 0]] = True
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.concatenate([starts, [total]]))
    kind, first_of = _distinct(chars, starts, lengths)

    node_ends, edge_start, edge_piece, cdf, edge_bounds, bases = _filtered(chars, starts[first_of], lengths[first_of], pieces)
    out = np.full(total, UNSET, dtype=np.int64)
    order = np.argsort(kind, kind="stable")  # equal words side by side, so that searches stay near each other
    starts, kind = starts[order], kind[order]
    at, node, base = starts + lengths[order], node_ends[kind], bases[kind]
    place = at - heads[row[starts]]
    seeds = mix(keys.astype(np.int64).view(np.uint64))[row[starts]]
    while len(at):
        with np.errstate(over="ignore"):
            bits = mix(seeds + mix(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        u = (bits >> np.uint64(11)).astype(np.float64) * 2.0**-53
        edge = np.searchsorted(cdf, node + u, side="right")
        edge = np.clip(edge, edge_bounds[node], edge_bounds[node + 1] - 1)
        came = edge_start[edge]
        step = node - came
        at, place, node = at - step, place - step, came
        out[at] = edge_piece[edge]
        more = node > base
        at, place, node, base, seeds = at[more], place[more], node[more], base[more], seeds[more]
    return _with_bytes(out, raw, row, len(texts), pieces)


def _distinct(chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which segments are equal: the number of each one's kind, and the first segment of every kind."""
    longest = int(lengths.max())
    codes = PLACES if longest <= len(PLACES) else sequence(1 << 50, longest) | np.uint64(1)
    inside = np.arange(len(chars)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        hashes = mix(np.add.reduceat(mix(chars.astype(np.uint64)) * codes[inside], starts) + lengths.astype(np.uint64))
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    twin = first[kind]
    same = (lengths == lengths[twin]) & np.logical_and.reduceat(chars == chars[np.minimum(np.repeat(starts[twin], lengths) + inside, len(chars) - 1)], starts)
    odd = np.flatnonzero(~same)  # equal hashes of unequal segments: kinds of their own
    kind[odd] = len(first) + np.arange(len(odd))
    return kind, np.concatenate([first, odd])


def _filtered(chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pieces: Lattice):
    """Forward filtering of distinct segments.

    A segment of n characters has n + 1 nodes, numbered on from the segment before. Returned are its last node; the start node
    and the piece of every edge, ordered by end node; their cumulated probabilities, raised by the end node's number so that
    one search over all of them finds a draw; the edges of each node; and each segment's first node.
    """
    heads = np.cumsum(lengths) - lengths
    segment = np.repeat(np.arange(len(starts)), lengths)
    inside = np.arange(int(lengths.sum())) - heads[segment]
    flat = chars[starts[segment] + inside]
    left = lengths[segment] - inside
    bases = heads + np.arange(len(starts))
    node_of = bases[segment] + inside

    at = np.arange(len(flat))
    node = pieces.first[flat].astype(np.int64)
    found_start, found_end, found_piece = [], [], []
    reached = np.where(node >= 0, pieces.piece[node], UNSET)
    # A character that is no piece by itself is one edge of bytes.
    found_start.append(node_of)
    found_end.append(node_of + 1)
    found_piece.append(np.where(reached >= 0, reached, UNKNOWN))
    size = 1
    while True:
        alive = (node >= 0) & (left > size)
        at, node, left = at[alive], node[alive], left[alive]
        if not len(at):
            break
        node = pieces.step(node, flat[at + size])
        size += 1
        hit = np.flatnonzero((node >= 0) & (pieces.piece[node] >= 0))
        found_start.append(node_of[at[hit]])
        found_end.append(node_of[at[hit]] + size)
        found_piece.append(pieces.piece[node[hit]])
    start, end, piece = map(np.concatenate, (found_start, found_end, found_piece))
    order = np.argsort(end, kind="stable")
    start, end, piece = start[order], end[order], piece[order]
    weight = np.where(piece >= 0, pieces.weight[np.maximum(piece, 0)], UNKNOWN_WEIGHT)

    nodes = int(lengths.sum()) + len(starts)
    bounds = np.searchsorted(end, np.arange(nodes + 1))
    place = np.zeros(nodes, dtype=np.int64)
    place[node_of + 1] = inside + 1
    alpha = np.zeros(nodes)
    # Nodes by their place in the segment: all edges into the nodes of one place are filtered at once.
    order = np.argsort(place.astype(np.int32), kind="stable")
    steps = np.searchsorted(place[order], np.arange(1, int(lengths.max()) + 2)).tolist()
    degree = np.diff(bounds)
    chance = np.zeros(len(end))
    for low, high in zip(steps, steps[1:]):
        into = order[low:high]
        many = degree[into]
        cut = np.cumsum(many) - many
        edges = np.repeat(bounds[into] - cut, many) + np.arange(int(many.sum()))
        value = alpha[start[edges]] + weight[edges]
        top = np.maximum.reduceat(value, cut)
        share = np.exp(value - np.repeat(top, many))
        total = np.add.reduceat(share, cut)
        alpha[into] = top + np.log(total)
        chance[edges] = share / np.repeat(total, many)
    run = np.cumsum(chance)
    before = np.concatenate([[0.0], run])[bounds[end]]
    return bases + lengths, start, piece, end + np.minimum(run - before, 1.0), bounds, bases


def _with_bytes(out: np.ndarray, raw: np.ndarray, row: np.ndarray, rows: int, pieces: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order, characters without a piece as the ids of their UTF-8 bytes."""
    held = np.flatnonzero(out != UNSET)
    ids, code = out[held], raw[held]
    unknown = ids == UNKNOWN
    width = np.where(unknown, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row[held], weights=width, minlength=rows).astype(np.int64))])
    if not unknown.any():
        return ids, bounds
    full = np.repeat(ids, width)
    spot = np.cumsum(width) - width
    for n, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
        some = np.flatnonzero(unknown & (width == n))
        for k in range(n):
            shifted = code[some] >> (6 * (n - 1 - k))
            value = (lead | shifted) if k == 0 else (0x80 | (shifted & 0x3F))
            full[spot[some] + k] = pieces.byte_ids[value]
    return full, bounds


def decode(ids: np.ndarray, bounds: np.ndarray, pieces: Lattice) -> list[bytes]:
    """The UTF-8 bytes of each text, from its ids; exactly what was encoded."""
    length = pieces.length[ids]
    ends = np.cumsum(length)
    spot = np.arange(int(length.sum())) - np.repeat(ends - length, length) + np.repeat(pieces.start[ids], length)
    data = pieces.bytes_of[spot].tobytes()
    cuts = np.concatenate([[0], ends])[bounds].tolist()
    return [data[a + 1 : b] for a, b in zip(cuts, cuts[1:])]  # without the space that every text is given


def sample_pieces(df: DataFrame, key: str, text: str = "text", out: str = "pieces", seed: int = 0, model: str = MODEL) -> DataFrame:
    """Add the sampled piece ids (array<int>) of every text; a column of that name is replaced.

    The same key, text and seed give the same segmentation on every run and under any partitioning. A null or empty text has
    no pieces; repeated rows repeat theirs; a null key is a key like others. Texts are read whole, and rows are not shuffled.
    """
    rows = df.drop(*({out} - {text})).withColumn("_key", F.xxhash64(F.col(key), F.lit(seed)))
    schema = T.StructType([*rows.drop("_key").schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    at, keyed = rows.columns.index(text), rows.columns.index("_key")

    def run(batches):
        pieces = lattice(model)
        for whole in batches:
            for batch in slices(whole, column=whole.schema.names[at], limit=ENCODE_BYTES):
                texts = [t or "" for t in batch.column(at).to_pylist()]
                ids, bounds = encode(texts, batch.column(keyed).to_numpy(zero_copy_only=False), pieces)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                kept = [c for i, c in enumerate(batch.columns) if i != keyed]
                yield pa.RecordBatch.from_arrays([*kept, lists], names=schema.names)

    return map_arrow(rows, run, schema)


def decode_pieces(df: DataFrame, ids: str = "pieces", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """Add the text that a column of piece ids stands for; null ids read as none, and none as the empty text."""
    rows = df.drop(out)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])
    at = rows.columns.index(ids)

    def run(batches):
        pieces = lattice(model)
        for batch in batches:
            lists = batch.column(at)
            bounds = np.concatenate([[0], np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))])
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            texts = [t.decode("utf-8", "replace") for t in decode(flat, bounds, pieces)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return map_arrow(rows, run, schema)


def round_trip(documents: DataFrame, seed: int = 0, model: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (little-endian unsigned 32-bit ids), decoded_sha256 and lossless for every document."""

    def run(batches):
        pieces = lattice(model)
        for whole in batches:
            for batch in slices(whole, limit=ENCODE_BYTES):
                texts = Texts(batch.column("text"))
                raw, ends = texts.data.tobytes(), texts.offsets.tolist()
                given = [raw[a:b] for a, b in zip(ends, ends[1:])]
                ids, bounds = encode([t.decode() for t in given], batch.column("_key").to_numpy(zero_copy_only=False), pieces)
                back = decode(ids, bounds, pieces)
                cuts, packed = bounds.tolist(), ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(np.diff(bounds)),
                        pa.array([zlib.crc32(packed[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in back], pa.string()),
                        pa.array([a == b for a, b in zip(given, back)], pa.bool_()),
                    ],
                    names=["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text", F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("_key"))
    return map_arrow(rows, run, f"doc_id {kind}, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, lossless boolean")
