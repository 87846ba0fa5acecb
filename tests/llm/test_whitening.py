"""Whitening against numpy on the whole table."""

import math

import numpy as np
import pytest

from gradloom.llm.whitening import pack, quantised, unpack, whiten

VECTORS = "vec_id bigint, embedding array<float>, label int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 0) for i, v in zip(ids, vectors)], VECTORS)


def plain(vectors):
    """Per row: deviation, explained and whitened up to signs; None for rows that take no part."""
    width = max((len(v) for v in vectors if v), default=0)
    good = [v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v) for v in vectors]
    x = [tuple(math.floor(256 * float(np.float32(c))) for c in v) if g else None for v, g in zip(vectors, good)]
    fit = sorted({v for v in x if v})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    used = min(4, int((values > 1e-12 * values[0]).sum()))
    white = [None if v is None else ((np.array(v, float) - np.array(sums) / n) @ parts[:, :used]) / np.sqrt(values[:used]) for v in x]
    deviation = [None if v is None else sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return n, white, deviation, values[:used] / values.sum()


def check(spark, vectors):
    n, white, deviation, explained = plain(vectors)
    rows = whiten(table(spark, vectors).repartition(3)).collect()
    held = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(held) == len(rows) == sum(w is not None for w in white) * len(explained)
    signs = {}
    for (i, c), r in held.items():
        want = white[i][c - 1]
        if abs(want) > 1e-6:
            signs.setdefault(c, math.copysign(1, want * r["whitened"]))
        assert r["whitened"] == pytest.approx(signs.get(c, 1) * want, rel=1e-7, abs=1e-7)
        assert (r["n"], r["deviation"]) == (n, deviation[i])
        assert r["explained"] == pytest.approx(explained[c - 1], rel=1e-7)
        assert r["identity_error"] < 1e-9
    return rows


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 12)) * np.array([30, 10, 5, 3, 1, 1, 1, 1, 0.5, 0.2, 0.1, 0.05])
    vectors = base.tolist() + [base[0].tolist()] * 200 + [None, [], [1.0] * 11, [float("nan")] * 12, [None] * 12, [math.inf] + [0.0] * 11]
    check(spark, vectors)


def test_flat_and_dependent_directions(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-50, 50, (60, 2)).astype(float)
    vectors = [[a, b, 7.0, a + b, a] for a, b in base.tolist()]
    rows = check(spark, vectors)
    assert {r["component"] for r in rows} == {1, 2}


def test_badly_conditioned_directions(spark):
    base = np.random.default_rng(3).normal(size=(200, 5)) * np.array([5e3, 100, 5, 0.5, 0.05])
    base[:, 1:] += base[:, :1] / 2
    check(spark, base.tolist())


def test_deviations_beyond_64_bits_are_null(spark):
    rows = whiten(table(spark, [[1e30, 0.0], [-1e30, 1.0], [2.0, 3.0], [2.0, 5.0]])).collect()
    assert {(r["vec_id"], r["deviation"] is None) for r in rows} == {(0, True), (1, True), (2, False), (3, False)}
    assert {r["component"] for r in rows} == {1}


def test_tables_without_variance(spark):
    assert whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whiten(table(spark, [None, [], None])).collect() == []
    assert whiten(table(spark, [[1.0, 2.0]] * 5)).collect() == []
    rows = check(spark, [[1.0, 2.0], [1.0, 3.0], [1.0, 3.0]])
    assert [r["component"] for r in rows] == [1, 1, 1]


def test_other_id_types_and_clashing_columns(spark):
    rows = table(spark, [[1.0, 2.0], [4.0, 3.0], [0.0, 0.5]]).selectExpr("concat('v', vec_id) AS vec_id", "embedding", "1 AS code", "2 AS n", "3 AS vector")
    assert {r["vec_id"] for r in whiten(rows).collect()} == {"v0", "v1", "v2"}


def test_codes_keep_every_long():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-(2**k), 2**k, (5, 3)) for k in (3, 9, 20, 40, 62)] + [np.array([[2**63 - 1, -(2**63), 0]])])
    import pyarrow as pa

    assert (unpack(pa.array(pack(x.ravel(), len(x)), pa.binary()), 3) == x).all()
    good, values = quantised(pa.array([[1e300, -1e300, -0.0], None, [0.001, -0.001, 1.0]], pa.list_(pa.float64())))
    assert good.tolist() == [True, False, True]
    assert values.tolist() == [2**63 - 1, -(2**63), 0, 0, -1, 256]
