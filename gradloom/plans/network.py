"""Layered models (none: softmax or linear regression) and their distributed gradient."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gradloom.functions.hashing import uniform_draws
from gradloom.plans.kernels import check_broadcast, feature_names, matrix, sum_partials
from gradloom.session import map_arrow

ACTIVATIONS = ("relu", "sigmoid", "tanh")


@dataclass
class NetworkModel:
    """Weights ``w0, b0, w1, b1, …``; ``layers`` lists the hidden widths."""

    width: int
    outputs: int
    layers: tuple[int, ...] = ()
    activation: str = "relu"
    regression: bool = False
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def initial(cls, width, outputs, layers=(), activation="relu", regression=False, seed=0) -> NetworkModel:
        """Zero weights without hidden layers, else the uniform ±sqrt(6 / (in + out)) start."""
        if activation not in ACTIVATIONS:
            raise ValueError(f"activation {activation!r} is not one of {ACTIVATIONS}")
        sizes = [width, *layers, outputs]
        draw, weights = np.random.default_rng(seed), {}
        for i, (rows, cols) in enumerate(zip(sizes, sizes[1:])):
            bound = np.sqrt(6.0 / (rows + cols)) if layers else 0.0
            weights[f"w{i}"] = draw.uniform(-1.0, 1.0, (rows, cols)) * bound
            weights[f"b{i}"] = np.zeros(cols)
        return cls(width, outputs, tuple(layers), activation, regression, weights)

    @property
    def depth(self) -> int:
        return len(self.layers) + 1

    @property
    def size(self) -> int:
        return sum(w.size for w in self.weights.values())

    def unflatten(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        arrays, at = {}, 0
        for name, w in self.weights.items():
            arrays[name] = flat[at : at + w.size].reshape(w.shape)
            at += w.size
        return arrays


def _activate(z: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    if kind == "relu":
        return np.maximum(z, 0.0), (z > 0).astype(np.float64)
    if kind == "sigmoid":
        a = 1.0 / (1.0 + np.exp(-z))
        return a, a * (1.0 - a)
    a = np.tanh(z)
    return a, 1.0 - a * a


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def checked_classes(labels: np.ndarray, classes: int) -> np.ndarray:
    """Labels as class numbers; anything but 0 .. classes - 1 raises."""
    if len(labels) and not ((labels >= 0) & (labels < classes) & (labels == np.floor(labels))).all():
        raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
    return labels.astype(np.int64)


def forward(model: NetworkModel, x, masks=None):
    """Outputs of a batch, with what back-propagation needs from each hidden layer."""
    held, w = [], model.weights
    z = x.times(w["w0"]) + w["b0"]
    for i in range(1, model.depth):
        a, slope = _activate(z, model.activation)
        if masks is not None:
            a, slope = a * masks[i - 1], slope * masks[i - 1]
        held.append((a, slope))
        z = a @ w[f"w{i}"] + w[f"b{i}"]
    return z, held


def batch_gradient(model: NetworkModel, x, answers: np.ndarray, row_weights: np.ndarray, masks=None):
    """Weighted loss sum and un-normalised gradient arrays of one batch."""
    z, held = forward(model, x, masks)
    if model.regression:
        delta = z - answers
        loss = 0.5 * float(row_weights @ (delta**2).sum(axis=1))
    else:
        p = softmax(z)
        rows = np.arange(len(answers))
        loss = -float(row_weights @ np.log(np.clip(p[rows, answers], 1e-15, 1.0)))
        delta = p
        delta[rows, answers] -= 1.0
    delta = delta * row_weights[:, None]
    gradients = {}
    for i in range(model.depth - 1, 0, -1):
        a, slope = held[i - 1]
        gradients[f"w{i}"], gradients[f"b{i}"] = a.T @ delta, delta.sum(axis=0)
        delta = (delta @ model.weights[f"w{i}"].T) * slope
    gradients["w0"], gradients["b0"] = x.transposed_times(delta), delta.sum(axis=0)
    return loss, gradients


def network_gradient(
    df: DataFrame, model: NetworkModel, parts: int, class_weights=None, dropout=0.0, seed=0, iteration=0
) -> tuple[float, float, dict[str, np.ndarray]]:
    """Mean loss, total weight and mean gradient over the rows of ``df``."""
    check_broadcast(8 * model.size, "the model")
    shipped = df.sparkSession.sparkContext.broadcast(model)
    weights_by_class = None if class_weights is None else np.asarray(class_weights, dtype=np.float64)
    answer = "targets" if model.regression else "label"

    def kernel(batches):
        held = shipped.value
        total, weight, loss = np.zeros(held.size), 0.0, 0.0
        for batch in batches:
            x = matrix(batch, held.width)
            answers = batch.column(answer)
            if held.regression:
                answers = answers.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, held.outputs)
            else:
                answers = checked_classes(answers.to_numpy(zero_copy_only=False), held.outputs)
            row_weights = (
                np.ones(batch.num_rows) if weights_by_class is None or held.regression else weights_by_class[answers]
            )
            masks = None
            if dropout and held.layers:
                ids = batch.column("row_id").to_numpy(zero_copy_only=False)
                draws = uniform_draws(seed, iteration, ids, sum(held.layers))
                kept = (draws >= dropout) / (1.0 - dropout)
                masks = np.split(kept, np.cumsum(held.layers)[:-1], axis=1)
            part_loss, gradients = batch_gradient(held, x, answers, row_weights, masks)
            loss += part_loss
            weight += row_weights.sum()
            total += np.concatenate([gradients[n].ravel() for n in held.weights])
        return (loss, weight, total) if weight else None

    columns = ([] if not (dropout and model.layers) else ["row_id"]) + [answer, *feature_names(df)]
    try:
        loss, weight, total = sum_partials(df.select(*columns), kernel, parts, model.size)
    finally:
        shipped.destroy()
    scale = 1.0 / weight if weight else 0.0
    return loss * scale, weight, model.unflatten(total * scale)


def network_scores(df: DataFrame, model: NetworkModel) -> DataFrame:
    """All columns but the features, plus ``scores``: probabilities, or raw outputs in regression."""
    check_broadcast(8 * model.size, "the model")
    shipped = df.sparkSession.sparkContext.broadcast(model)
    used = feature_names(df)
    kept = [c for c in df.columns if c not in used]

    def score(batches):
        held = shipped.value
        for batch in batches:
            z, _ = forward(held, matrix(batch, held.width))
            out = z if held.regression else softmax(z)
            offsets = pa.array(np.arange(0, out.size + 1, held.outputs, dtype=np.int32))
            scores = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], scores], names=[*kept, "scores"])

    schema = df.select(*kept).schema.add("scores", T.ArrayType(T.DoubleType()))
    return map_arrow(df.select(*kept, *used), score, schema)
