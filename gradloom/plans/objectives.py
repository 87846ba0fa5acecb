"""Gradients of the boosting objectives, on whole arrays of margins."""

from __future__ import annotations

import numpy as np

from gradloom.plans.network import checked_classes, softmax

# Names of the objectives and of the boosters.
OBJECTIVES = ("multi:softprob", "binary:logistic", "reg:linear", "reg:logistic")
BOOSTERS = ("gbtree", "dart", "gblinear")


def outputs(objective: str, nclasses: int) -> int:
    if objective not in OBJECTIVES:
        raise ValueError(f"objective {objective!r} is not one of {OBJECTIVES}")
    return nclasses if objective == "multi:softprob" else 1


def start_margin(objective: str, base_score: float) -> float:
    """Margin that stands for ``base_score`` before the first round."""
    if objective in ("binary:logistic", "reg:logistic"):
        return float(np.log(base_score / (1.0 - base_score)))
    return float(base_score)


def gradients(objective: str, margin: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """First and second derivatives, ``[rows, outputs]``."""
    if objective == "multi:softprob":
        p = softmax(margin)
        g = p.copy()
        g[np.arange(len(label)), checked_classes(label, margin.shape[1])] -= 1.0
        h = np.maximum(2.0 * p * (1.0 - p), 1e-16)
    elif objective == "reg:linear":
        g, h = margin - label[:, None], np.ones_like(margin)
    else:
        if objective == "binary:logistic":
            label = checked_classes(label, 2)
        elif not ((label >= 0) & (label <= 1)).all():
            raise ValueError("targets of reg:logistic must lie in 0 .. 1")
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - label[:, None], np.maximum(p * (1.0 - p), 1e-16)
    return g * weight[:, None], h * weight[:, None]


def scores(objective: str, margin: np.ndarray) -> np.ndarray:
    """Class probabilities; a single number per row for the regression objectives."""
    if objective == "multi:softprob":
        return softmax(margin)
    if objective == "reg:linear":
        return margin
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.hstack([1.0 - p, p]) if objective == "binary:logistic" else p


def losses(objective: str, margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Training loss of every row: half the squared error, or -ln p(true class) with p clipped to [1e-15, 1]."""
    found = scores(objective, margin)
    if objective.startswith("reg:"):
        return (found[:, 0] - label) ** 2 / 2.0
    return -np.log(np.clip(found[np.arange(len(label)), label.astype(np.int64)], 1e-15, 1.0))
