"""Small gradient-boosted trees for whole-number features, scored as SQL expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 40
DEPTH = 3
RATE = 0.3
L2 = 1.0


@dataclass(frozen=True)
class Split:
    """Rows whose feature is at most ``limit`` go left; leaves are plain numbers."""

    feature: int
    limit: int
    left: Split | float
    right: Split | float


def _grow(x: np.ndarray, slope: np.ndarray, bend: np.ndarray, depth: int) -> Split | float:
    """Second-order gain over every threshold of every feature."""
    total_slope, total_bend = slope.sum(), bend.sum()
    best = (1e-6, -1, 0)
    for feature in range(x.shape[1] if depth else 0):
        order = np.argsort(x[:, feature], kind="stable")
        value = x[order, feature]
        ends = np.flatnonzero(value[1:] != value[:-1])
        if ends.size == 0:
            continue
        s, b = np.cumsum(slope[order])[ends], np.cumsum(bend[order])[ends]
        gain = (
            s**2 / (b + L2)
            + (total_slope - s) ** 2 / (total_bend - b + L2)
            - total_slope**2 / (total_bend + L2)
        )
        top = int(gain.argmax())
        if gain[top] > best[0]:
            best = (float(gain[top]), feature, int(value[ends[top]]))
    _, feature, limit = best
    if feature < 0:
        return float(RATE * total_slope / (total_bend + L2))
    left = x[:, feature] <= limit
    return Split(
        feature,
        limit,
        _grow(x[left], slope[left], bend[left], depth - 1),
        _grow(x[~left], slope[~left], bend[~left], depth - 1),
    )


def _values(tree: Split | float, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(x.shape[0], tree)
    left = x[:, tree.feature] <= tree.limit
    return np.where(left, _values(tree.left, x), _values(tree.right, x))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, weight: np.ndarray | None = None
) -> list[Split | float]:
    """Trees whose sum is the log-odds of y; ``weight`` counts equal rows as that many."""
    weight = np.ones(y.size) if weight is None else weight
    trees: list[Split | float] = []
    odds = np.zeros(y.size)
    for _ in range(rounds if y.size else 0):
        chance = 1 / (1 + np.exp(-odds))
        trees.append(_grow(x, weight * (y - chance), weight * chance * (1 - chance), DEPTH))
        odds += _values(trees[-1], x)
    return trees


def log_odds(trees: list[Split | float], x: np.ndarray) -> np.ndarray:
    return sum((_values(t, x) for t in trees), np.zeros(x.shape[0]))


def expression(trees: list[Split | float], feature: Callable[[int], Column]) -> Column:
    """The same sum as a column."""

    def node(tree: Split | float) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        return F.when(feature(tree.feature) <= tree.limit, node(tree.left)).otherwise(
            node(tree.right)
        )

    total = F.lit(0.0)
    for tree in trees:
        total = total + node(tree)
    return total
