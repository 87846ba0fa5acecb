"""Learning-rate schedules, as a column and as a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the schedules.
POLICIES = ("fixed", "step", "inv")


def _known(policy: str | None) -> str:
    policy = policy or "fixed"
    if policy not in POLICIES:
        raise ValueError(f"learning-rate policy {policy!r} is not one of {POLICIES}")
    return policy


def rate_at(policy, iteration: int, base_lr: float, gamma=None, stepsize=None, power=None) -> float:
    policy = _known(policy)
    if policy == "step":
        return base_lr * gamma ** (iteration // stepsize)
    if policy == "inv":
        return base_lr * (1.0 + gamma * iteration) ** -power
    return base_lr


def rate_column(policy, iteration: Column, base_lr: float, gamma=None, stepsize=None, power=None) -> Column:
    policy = _known(policy)
    if policy == "step":
        return F.lit(base_lr) * F.pow(F.lit(gamma), F.floor(iteration / F.lit(stepsize)))
    if policy == "inv":
        return F.lit(base_lr) * F.pow(F.lit(1.0) + F.lit(gamma) * iteration, F.lit(-power))
    return F.lit(float(base_lr))
