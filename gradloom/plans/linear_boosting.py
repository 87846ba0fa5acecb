"""Linear booster: soft-thresholded coordinate descent on sums that each round gathers from the rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradloom.functions.hashing import uniform_draws
from gradloom.plans import objectives
from gradloom.plans.boosting import BoosterParams
from gradloom.plans.kernels import check_broadcast, feature_names, feature_width, matrix, sum_partials
from gradloom.session import map_arrow, persist_balanced


@dataclass
class LinearEnsemble:
    objective: str
    start: float
    weights: np.ndarray  # [features, outputs]
    bias: np.ndarray  # [outputs]

    @property
    def width(self) -> int:
        return self.weights.shape[0]

    @property
    def nout(self) -> int:
        return self.weights.shape[1]

    def margins(self, x) -> np.ndarray:
        return x.times(self.weights) + self.bias + self.start

    def arrays(self) -> dict[str, np.ndarray]:
        code = objectives.OBJECTIVES.index(self.objective)
        return {"linear.weights": self.weights, "linear.bias": self.bias, "linear.shape": np.array([code, self.start])}

    @classmethod
    def from_arrays(cls, arrays: dict[str, np.ndarray]) -> LinearEnsemble:
        code, start = arrays["linear.shape"]
        return cls(objectives.OBJECTIVES[int(code)], float(start), arrays["linear.weights"], arrays["linear.bias"])


def _coordinate_change(g, h, w, l1: float, l2: float):
    """Change of w that minimises the second-order loss with its penalties; never crosses zero."""
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.maximum(-(g + l2 * w + l1) / (h + l2), -w)
        down = np.minimum(-(g + l2 * w - l1) / (h + l2), -w)
        change = np.where(w - (g + l2 * w) / (h + l2) >= 0.0, up, down)
    return np.where(h < 1e-5, 0.0, change)


# Features whose second-order products are gathered in one pass.
BLOCK_FEATURES = 512


def linear_round(rows: DataFrame, model: LinearEnsemble, parts: int, p: BoosterParams, seed: int, round_: int) -> LinearEnsemble:
    """The bias, then one coordinate after the other, each seeing the changes before it.

    First and second derivatives are taken at the round's start. A pass over the rows gathers, for one block of
    features, their gradient sums and the products of their columns weighted by h; with these the coordinates of the block
    are updated one by one without looking at rows again. Wide models take one pass per block, whose gradients already
    hold the blocks before.
    """
    d, k = model.weights.shape
    check_broadcast(8 * model.weights.size, "the linear model")
    change, shift = np.zeros((d, k)), np.zeros(k)
    for low in range(0, max(d, 1), BLOCK_FEATURES):
        high = min(d, low + BLOCK_FEATURES)
        sums = _block_sums(rows, model, change, shift, low, high, parts, p, seed, round_)
        g, h, gx, hx, products = sums
        if low == 0:
            shift = p.eta * -(g + p.lambda_bias * model.bias) / np.maximum(h + p.lambda_bias, 1e-16)
            gx = gx + hx * shift
        for j in range(high - low):
            held = model.weights[low + j]
            step = p.eta * _coordinate_change(gx[j], products[:, j, j], held, p.reg_alpha, p.reg_lambda)
            change[low + j] = step
            gx = gx + products[:, :, j].T * step
    return LinearEnsemble(model.objective, model.start, model.weights + change, model.bias + shift)


def _block_sums(rows, model, change, shift, low, high, parts, p, seed, round_):
    """Σg, Σh, Σgx, Σhx and Σh·x·x of the features low..high, g as it is after ``change`` and ``shift``."""
    d, k = model.weights.shape
    width = high - low
    size = k * (2 + 2 * width + width * width)
    shipped = rows.sparkSession.sparkContext.broadcast((model, change, shift))

    def kernel(batches):
        held, changed, shifted = shipped.value
        total, seen = np.zeros(size), 0.0
        for batch in batches:
            x = matrix(batch, d)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            weight = batch.column("weight").to_numpy(zero_copy_only=False)
            if p.subsample < 1.0:
                ids = batch.column("row_id").to_numpy(zero_copy_only=False)
                weight = weight * (uniform_draws(seed, round_, ids, 1)[:, 0] < p.subsample)
            g, h = objectives.gradients(held.objective, held.margins(x), label, weight)
            if low:
                g = g + h * (x.times(changed) + shifted)
            block = x.columns(low, high)
            products = [block.T @ (block * h[:, [c]]) for c in range(k)]
            parts_ = [g.sum(axis=0), h.sum(axis=0), block.T @ g, block.T @ h, *products]
            total += np.concatenate([s.ravel() for s in parts_])
            seen += weight.sum()
        return 0.0, seen, total

    try:
        _, _, total = sum_partials(rows, kernel, parts, size)
    finally:
        shipped.destroy()
    g, h = total[:k], total[k : 2 * k]
    gx, hx = (total[2 * k + i * width * k :][: width * k].reshape(width, k) for i in range(2))
    return g, h, gx, hx, total[2 * k * (1 + width) :].reshape(k, width, width)


def train_linear(train, objective, nclasses, iterations, base_score, seed, p: BoosterParams, model=None, after_round=None):
    nout = objectives.outputs(objective, nclasses)
    if model is None:
        width = p.num_feature or feature_width(train)
        start = objectives.start_margin(objective, base_score)
        model = LinearEnsemble(objective, start, np.zeros((width, nout)), np.zeros(nout))
    weight = F.lit(1.0)
    if p.scale_pos_weight != 1.0:
        weight = F.when(F.col("label") == 1, float(p.scale_pos_weight)).otherwise(1.0)
    ids = ["row_id"] if p.subsample < 1.0 else []
    rows = train.select(*ids, F.col("label").cast("double").alias("label"), weight.alias("weight"), *feature_names(train))
    rows, parts = persist_balanced(rows, 8 * model.width + 16)
    try:
        for round_ in range(iterations):
            model = linear_round(rows, model, parts, p, seed, round_)
            if after_round is not None:
                after_round(model)
    finally:
        rows.unpersist()
    return model


def linear_scores(df: DataFrame, model: LinearEnsemble) -> DataFrame:
    check_broadcast(8 * model.weights.size, "the linear model")
    shipped = df.sparkSession.sparkContext.broadcast(model)
    used = feature_names(df)
    kept = [c for c in df.columns if c not in used]

    def score(batches):
        for batch in batches:
            out = objectives.scores(shipped.value.objective, shipped.value.margins(matrix(batch, shipped.value.width)))
            offsets = pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32))
            scores = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], scores], names=[*kept, "scores"])

    return map_arrow(df.select(*kept, *used), score, df.select(*kept).schema.add("scores", T.ArrayType(T.DoubleType())))
