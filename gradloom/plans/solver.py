"""Solver settings and update rules; updates act on model-sized arrays after a distributed gradient."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from gradloom.functions.schedules import rate_at

# Names of the update rules.
RULES = ("SGD", "ADAGRAD", "NESTEROV", "RMSPROP", "ADADELTA", "ADAM")

EPSILON = 1e-8


@dataclass(frozen=True)
class SolverConfig:
    """How to train: number of iterations, update rule, schedule, evaluation and snapshot intervals.

    Fixed values: names and order of the settings, which callers give by position.
    """

    iterations: int = 10
    snapshot: int | None = None
    snapshot_prefix: str | None = None
    solver_type: str = "SGD"
    test_interval: int | None = None
    test_initialization: bool = True
    lr_policy: str | None = None
    base_lr: float = 0.01
    gamma: float | None = None
    stepsize: int | None = None
    momentum: float | None = None
    weight_decay: float | None = None
    power: float | None = None
    iter_size: int = 1

    def rate(self, iteration: int) -> float:
        return rate_at(self.lr_policy, iteration, self.base_lr, self.gamma, self.stepsize, self.power)


@dataclass
class SolverState:
    """Step counter and the moment arrays of the update rule."""

    step: int = 0
    moments: dict[str, np.ndarray] = field(default_factory=dict)


def solver_step(config: SolverConfig, state: SolverState, weights: dict, gradients: dict) -> dict:
    """New weights after one update; ``state`` moves along."""
    if config.solver_type not in RULES:
        raise ValueError(f"solver {config.solver_type!r} is not one of {RULES}")
    rate = config.rate(state.step)
    state.step += 1
    return {name: w - _change(config, state, name, gradients[name], rate) for name, w in weights.items()}


def _change(config: SolverConfig, state: SolverState, name: str, g: np.ndarray, rate: float) -> np.ndarray:
    def moment(kind: str) -> np.ndarray:
        return state.moments.get(f"{kind}.{name}", np.zeros_like(g))

    def keep(kind: str, value: np.ndarray) -> np.ndarray:
        state.moments[f"{kind}.{name}"] = value
        return value

    rule = config.solver_type
    if rule == "SGD":
        return keep("velocity", (config.momentum or 0.0) * moment("velocity") + rate * g)
    if rule == "NESTEROV":
        mu, old = config.momentum or 0.0, moment("velocity")
        new = keep("velocity", mu * old + rate * g)
        return (1.0 + mu) * new - mu * old
    if rule == "ADAGRAD":
        return rate * g / (np.sqrt(keep("square", moment("square") + g * g)) + EPSILON)
    if rule == "RMSPROP":
        return rate * g / (np.sqrt(keep("square", 0.99 * moment("square") + 0.01 * g * g)) + EPSILON)
    if rule == "ADADELTA":
        rho = 0.95 if config.momentum is None else config.momentum
        square = keep("square", rho * moment("square") + (1.0 - rho) * g * g)
        change = g * np.sqrt((moment("change") + EPSILON) / (square + EPSILON))
        keep("change", rho * moment("change") + (1.0 - rho) * change * change)
        return rate * change
    beta1, beta2 = 0.9 if config.momentum is None else config.momentum, 0.999
    first = keep("first", beta1 * moment("first") + (1.0 - beta1) * g)
    second = keep("second", beta2 * moment("second") + (1.0 - beta2) * g * g)
    correction = np.sqrt(1.0 - beta2**state.step) / (1.0 - beta1**state.step)
    return rate * correction * first / (np.sqrt(second) + EPSILON)
