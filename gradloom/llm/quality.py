"""Quality rules: lines labelled as content or boilerplate by a linear-chain conditional random field."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.functions.hashing import seeded_md5
from gradloom.llm.batches import map_arrow
from gradloom.llm.kernels import (
    Texts, Words, mix, segment_sums, slices, window_hashes, windows_inside,
)
from gradloom.session import local_table

WINDOW = 5
# Fixed values of the rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
# The field is fitted on at most this many labelled documents and this many of their lines.
FIT_DOCUMENTS, FIT_LINES = 2_000, 100_000
FIT_STEPS, FIT_RATE, FIT_L2 = 150, 0.3, 1e-3
# Share of a document's words that must lie in content lines.
CONTENT_SHARE = 0.5

FEATURES = (
    "bias", "symbols", "upper", "digits", "bars", "shouts", "words", "word length", "ends a sentence",
    "copies a line", "repeated words",
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _members(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


IS_SYMBOL, IS_DIGIT, IS_SHOUT, IS_STOP = _members(SYMBOLS), _members(b"0123456789"), _members(b"!"), _members(b".!?:;\"'")
IS_UPPER, IS_LETTER, IS_BAR = np.zeros(256, bool), np.ones(256, bool), _members(b"|")
IS_UPPER[65:91] = True
IS_LETTER[:65] = IS_LETTER[91:97] = IS_LETTER[123:128] = False
IS_CODE_POINT = (np.arange(256) & 0xC0) != 0x80


@dataclass
class Measured:
    """Base measures per row (a column each), and one row of features per line that holds a word."""

    base: dict[str, np.ndarray]
    features: np.ndarray
    line_words: np.ndarray
    line_bounds: np.ndarray


def measure(column: pa.Array) -> Measured:
    """Words, symbols, repeats and line features of a batch of texts; nulls read as empty."""
    texts = Texts(column)
    words = Words(texts)
    data = texts.data
    repeated = repeated_words(words)
    line_bounds, first_line = line_bounds_of(texts)
    line_words_from = np.searchsorted(words.starts, line_bounds)
    words_in_line = np.diff(line_words_from)
    copies = copied_lines(data, line_bounds, first_line, words_in_line)
    base = {
        "n_words": np.diff(words.bounds),
        "word_chars": texts.sums(words.inside & IS_CODE_POINT[data]),
        "n_symbols": texts.sums(IS_SYMBOL[data]),
        "n_dup_lines": segment_sums(copies, first_line),
        "n_repeat_words": segment_sums(repeated, words.bounds),
    }
    held = np.flatnonzero(words_in_line)
    count = words_in_line[held].astype(np.float64)

    def per_line(table: np.ndarray) -> np.ndarray:
        return segment_sums(table[data], line_bounds)[held]

    letters = np.maximum(per_line(IS_LETTER), 1)
    chars = segment_sums(words.inside, line_bounds)[held].astype(np.float64)
    last_byte = data[words.ends[line_words_from[1:][held] - 1] - 1] if len(held) else np.zeros(0, np.uint8)
    features = np.stack(
        [
            np.ones(len(held)),
            np.minimum(per_line(IS_SYMBOL) / count, 3.0),
            per_line(IS_UPPER) / letters,
            np.minimum(per_line(IS_DIGIT) / chars, 1.0),
            np.minimum(per_line(IS_BAR) / count, 1.0),
            np.minimum(per_line(IS_SHOUT) / count, 2.0),
            np.log1p(count) / 4.0,
            np.minimum(chars / count / 10.0, 3.0),
            IS_STOP[last_byte],
            copies[held],
            segment_sums(repeated, line_words_from)[held] / count,
        ],
        axis=1,
    ).astype(np.float64)
    return Measured(base, features, count, np.searchsorted(held, first_line))


def repeated_words(words: Words) -> np.ndarray:
    """Whether a word lies in a window of five words that stands twice or more in its row; one flag per word."""
    n = len(words.starts)
    inside = windows_inside(words.bounds, WINDOW, n - WINDOW + 1)
    at = np.flatnonzero(inside)
    flags = np.zeros(n + 1, dtype=np.int64)
    if len(at):
        with np.errstate(over="ignore"):
            rows = words.row_of()[at].astype(np.uint64)
            keys = mix(window_hashes(words.hashes(lower=False), WINDOW)[at] + mix(rows + np.uint64(1)))
        order = np.argsort(keys, kind="stable")
        held = keys[order]
        same = held[1:] == held[:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(flags, at[twice], 1)
        np.add.at(flags, at[twice] + WINDOW, -1)
    return np.cumsum(flags)[:n] > 0


def line_bounds_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of all lines, each with its line end; and the first line of each row (rows + 1 values)."""
    ends = np.flatnonzero(texts.data == 10) + 1
    per_row = np.diff(np.searchsorted(ends, texts.offsets, side="right"))
    # A row has one line more than it has line ends; that one runs to the row's end and may be empty.
    bounds = np.sort(np.concatenate([[0], ends, texts.offsets[1:]]), kind="stable")
    return bounds, np.concatenate([[0], np.cumsum(per_row + 1)])


def copied_lines(data: np.ndarray, bounds: np.ndarray, first_line: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether a line with a word equals an earlier line of its row; lines are compared as bytes."""
    flags = np.zeros(len(bounds) - 1, dtype=bool)
    raw, ends = data.tobytes(), bounds.tolist()
    for low, high in zip(first_line[:-1].tolist(), first_line[1:].tolist()):
        if high - low < 2:
            continue
        seen = set()
        for i in range(low, high):
            if words[i]:
                line = raw[ends[i] : ends[i + 1]].rstrip(b"\n")
                if line in seen:
                    flags[i] = True
                seen.add(line)
    return flags


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEATED_PERCENT * base["n_words"])


@dataclass
class LineField:
    """A chain of two labels (0 boilerplate, 1 content): scores of features per label, and of label pairs."""

    emit: np.ndarray
    step: np.ndarray

    def viterbi(self, scores: np.ndarray) -> list[int]:
        """The best labels of one document's lines, from their emission scores; ties go to content."""
        if not len(scores):
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        rows = scores.tolist()
        (a0, a1), came = rows[0], []
        for e0, e1 in rows[1:]:
            from0, from1 = a1 + s10 >= a0 + s00, a1 + s11 >= a0 + s01
            came.append((from0, from1))
            a0, a1 = e0 + (a1 + s10 if from0 else a0 + s00), e1 + (a1 + s11 if from1 else a0 + s01)
        label = int(a1 >= a0)
        labels = [label]
        for from0, from1 in reversed(came):
            label = int(from1 if label else from0)
            labels.append(label)
        return labels[::-1]


def fit_field(sequences: list[tuple[np.ndarray, int]]) -> LineField:
    """Conditional log-likelihood by gradient ascent (Adam); each sequence is (lines x features, label of all its lines).

    Sums over label sequences are taken by forward and backward passes, the t-th lines of all sequences at once.
    Without both labels among the sequences the field finds content everywhere.
    """
    width = len(FEATURES)
    field = LineField(np.zeros((width, 2)), np.zeros((2, 2)))
    sequences = [s for s in sequences if len(s[0])]
    if len({y for _, y in sequences}) < 2:
        return field
    sequences.sort(key=lambda s: -len(s[0]))
    lengths = np.array([len(lines) for lines, _ in sequences])
    labels = np.array([y for _, y in sequences])
    weight = 1.0 / lengths  # every document weighs the same
    x = np.concatenate([lines for lines, _ in sequences])
    line_weight, truth = np.repeat(weight, lengths), np.eye(2)[np.repeat(labels, lengths)]
    # The t-th lines of all sequences that have one: the longest sequences come first.
    heads = np.cumsum(lengths) - lengths
    places = [heads[: int((lengths > t).sum())] + t for t in range(int(lengths[0]))]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels, labels), weight * (lengths - 1))
    moments = [[np.zeros_like(a), np.zeros_like(a)] for a in (field.emit, field.step)]
    for t in range(1, FIT_STEPS + 1):
        marginal, pairs = _marginals(x @ field.emit, field.step, places, weight)
        grad_emit = x.T @ ((truth - marginal) * line_weight[:, None]) / weight.sum() - FIT_L2 * field.emit
        grad_step = (seen - pairs) / weight.sum() - FIT_L2 * field.step
        for value, grad, (m, v) in zip((field.emit, field.step), (grad_emit, grad_step), moments):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            value += FIT_RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return field


def _marginals(scores: np.ndarray, step: np.ndarray, places: list[np.ndarray], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label marginals of every line, and expected label pairs over all sequences, weighted by sequence.

    Chances are scaled to sum to one at every line, so nothing under- or overflows on long documents.
    """
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    leap = np.exp(step - step.max())
    ahead, behind = np.empty_like(local), np.ones_like(local)
    ahead[places[0]] = local[places[0]] / local[places[0]].sum(axis=1, keepdims=True)
    for at in places[1:]:
        into = (ahead[at - 1] @ leap) * local[at]
        ahead[at] = into / into.sum(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    for at in reversed(places[1:]):
        coming = local[at] * behind[at]
        out = coming @ leap.T
        behind[at - 1] = out / out.sum(axis=1, keepdims=True)
        both = ahead[at - 1][:, :, None] * leap[None] * coming[:, None, :]
        pairs += np.einsum("nij,n->ij", both / both.sum(axis=(1, 2), keepdims=True), weight[: len(at)])
    marginal = ahead * behind
    return marginal / marginal.sum(axis=1, keepdims=True), pairs


def fit_line_field(documents: DataFrame, labels: DataFrame) -> LineField:
    """Fit on a bounded sample: the first ``FIT_DOCUMENTS`` labelled documents in seeded hash order, ``FIT_LINES`` lines.

    Lines carry the quality label of their document. Lines are counted first; documents are taken in hash order while their
    sum stays within ``FIT_LINES``, and one that does not fit is passed over. Only the features of those taken reach the driver. Of several
    texts of a doc_id the one with the least digest counts. Labels that are null or not 0 or 1, and labels without a
    document, are left out; ids may be of any type.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    some = (
        known.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("y"))
        .select("doc_id", "y", seeded_md5(0, F.col("doc_id")).alias("place"))
        .orderBy("place", "doc_id")
        .limit(FIT_DOCUMENTS)
    )
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")
    rows = documents.select("doc_id", "text", key).join(F.broadcast(some), "doc_id").select("doc_id", "place", "key", "y", "text")

    def lines(kept: bool):
        def run(batches):
            for whole in batches:
                for batch in slices(whole):
                    found = measure(batch.column("text"))
                    ends = found.line_bounds
                    held = [found.features[a:b].tobytes() if kept else None for a, b in zip(ends.tolist(), ends[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns[:4], pa.array(np.diff(ends).astype(np.int64)), pa.array(held, pa.binary())],
                        names=["doc_id", "place", "key", "y", "n", "lines"],
                    )

        return run

    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, place string, key bigint, y int, n bigint, lines binary"
    counted = map_arrow(rows, lines(False), schema).groupBy("doc_id", "place").agg(F.min(F.struct("key", "n")).alias("one"))
    taken, held = [], 0
    for row in sorted(counted.select("doc_id", "place", "one.*").collect(), key=lambda r: (r["place"], str(r["doc_id"]))):
        if held + row["n"] <= FIT_LINES:
            held += row["n"]
            taken.append((row["place"], row["key"]))
    if not taken:
        return fit_field([])
    chosen = F.broadcast(local_table(documents.sparkSession, taken, "place string, key bigint"))
    found = map_arrow(rows.join(chosen, ["place", "key"]).select(*rows.columns), lines(True), schema)
    single = found.groupBy("place", "key").agg(F.first("lines").alias("lines"), F.first("y").alias("y"))
    features = sorted(single.collect(), key=lambda r: (r["place"], r["key"]))
    return fit_field([(np.frombuffer(r["lines"]).reshape(-1, len(FEATURES)), r["y"]) for r in features])


def judge_quality(documents: DataFrame, field: LineField) -> DataFrame:
    """Add the base measures, base_failed, content_share and kept to every row; columns of these names are replaced.

    Viterbi decoding labels the lines that hold a word; the content share is the part of a document's words in content
    lines (0 without words). ``kept`` needs the base rules and a share of ``CONTENT_SHARE`` or more. A null text has no
    words and fails; repeated rows are judged alike; an empty table stays empty. Rows are not shuffled.
    """
    added = [(name, "long", pa.int64()) for name in MEASURES] + [
        ("base_failed", "boolean", pa.bool_()), ("content_share", "double", pa.float64()), ("kept", "boolean", pa.bool_()),
    ]
    rows = documents.drop(*[name for name, _, _ in added])
    schema = T.StructType(list(rows.schema.fields))
    for name, kind, _ in added:
        schema = schema.add(name, kind)
    at = rows.columns.index("text")

    def judge(batches):
        for whole in batches:
            for batch in slices(whole, column=whole.schema.names[at]):
                found = measure(batch.column(at))
                failed = base_failed(found.base)
                scores = found.features @ field.emit
                share = np.zeros(batch.num_rows)
                ends = found.line_bounds.tolist()
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    if b > a:
                        label = np.array(field.viterbi(scores[a:b]))
                        share[i] = (found.line_words[a:b] * label).sum() / found.line_words[a:b].sum()
                new = [*found.base.values(), failed, share, ~failed & (share >= CONTENT_SHARE)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *[pa.array(v, t) for v, (_, _, t) in zip(new, added)]],
                    names=[*batch.schema.names, *[name for name, _, _ in added]],
                )

    return map_arrow(rows, judge, schema)
