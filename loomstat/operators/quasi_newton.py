"""Limited-memory quasi-Newton minimisation of a loss over DataFrame rows, with L1 by projected steps.

A step's direction comes from the last few pairs of (move, change of gradient); the line search tries lengths
one, a half, a quarter and so on, and each try is one aggregate over the held rows to d + 2 numbers, whose
gradient the accepted try passes on. The loss is any gradient that ``descent`` takes, so a caller
brings their own; rows stay on the executors.

With L1 the objective has kinks at zero. The direction then follows the gradient that decreases the
objective on the side where it may go, and a step stops at zero in every weight whose sign it would
change (orthant-wise steps), so weights become zero exactly.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame

from loomstat.operators.descent import Descent, Gradient, evaluations

SUFFICIENT = 1e-4  # share of the promised decrease that a step must keep
TRIES = 40

Measure = Callable[[np.ndarray], tuple[np.ndarray, float] | None]


def _pseudo_gradient(weights: np.ndarray, gradient: np.ndarray, l1: float) -> np.ndarray:
    """Least slope of loss + l1 |w|: zero where neither side of a zero weight leads down."""
    up, down = gradient + l1, gradient - l1
    at_zero = np.where(up < 0, up, np.where(down > 0, down, 0.0))
    return np.where(weights > 0, up, np.where(weights < 0, down, at_zero))


def _direction(slope: np.ndarray, pairs: deque) -> np.ndarray:
    """The two-loop product of the inverse curvature, as far as the pairs know it, with the slope."""
    q, shares = slope.copy(), []
    for move, change in reversed(pairs):
        share = (move @ q) / (move @ change)
        q -= share * change
        shares.append(share)
    if pairs:
        move, change = pairs[-1]
        q *= (move @ change) / (change @ change)
    for (move, change), share in zip(pairs, reversed(shares)):
        q += move * (share - (change @ q) / (move @ change))
    return -q


def minimize(measure: Measure, start: Sequence[float], l1: float, l2: float, num_iterations: int, memory: int, tolerance: float) -> Descent:
    """Weights and the objective after each step; ``measure`` gives a mean gradient and loss, or None."""
    weights = np.array(start, dtype=float)

    def objective(at: np.ndarray):
        found = measure(at)
        if found is None:
            return None
        gradient, loss = found
        return gradient + l2 * at, loss + 0.5 * l2 * float(at @ at) + l1 * float(np.abs(at).sum())

    here, losses, pairs = objective(weights), [], deque(maxlen=memory)
    if here is None:
        return Descent([float(w) for w in weights], [])
    gradient, value = here
    losses.append(value)
    for _ in range(num_iterations):
        slope = _pseudo_gradient(weights, gradient, l1) if l1 else gradient
        if float(np.abs(slope).max(initial=0.0)) <= tolerance * max(1.0, abs(value)):
            break
        way = _direction(slope, pairs)
        if l1:
            way = np.where(way * slope < 0, way, 0.0)
        if way @ slope >= 0:  # what the pairs know does not lead down
            way, _ = -slope, pairs.clear()
        side = np.where(weights != 0, np.sign(weights), -np.sign(slope))
        length = 1.0 if pairs else min(1.0, 1.0 / float(np.abs(slope).sum()))
        for _ in range(TRIES):
            moved = weights + length * way
            if l1:
                moved = np.where(moved * side > 0, moved, 0.0)
            tried = objective(moved)
            if tried[1] <= value + SUFFICIENT * float(slope @ (moved - weights)):
                break
            length /= 2
        else:
            break  # no shorter step leads down: rounding is all that is left
        move, change = moved - weights, tried[0] - gradient
        if move @ change > 1e-12 * (change @ change):
            pairs.append((move, change))
        settled = abs(value - tried[1]) <= tolerance * max(1.0, abs(value)) * 1e-3
        weights, (gradient, value) = moved, tried
        losses.append(value)
        if settled:
            break
    return Descent([float(w) + 0.0 for w in weights], losses)


def fit(
    rows: DataFrame,
    label: str,
    features: str | Sequence[str],
    gradient: Gradient,
    reg_type: str = "L2",
    reg_param: float = 0.1,
    num_iterations: int = 100,
    memory: int = 10,
    tolerance: float = 1e-6,
    initial: Sequence[float] | None = None,
) -> Descent:
    """Minimise the mean loss plus ``reg_param`` times |w| (L1), w'w / 2 (L2) or nothing (NONE).

    ``features`` names double columns, or one vector column (linear gradients only). Rows with a null
    label or feature are left out; no rows leave the start, zero unless given, as it is. The search ends
    when the slope falls below ``tolerance`` of the objective or a step hardly changes it.
    """
    if reg_type not in ("NONE", "L1", "L2"):
        raise ValueError(f"unknown reg_type {reg_type}: use NONE, L1 or L2")
    l1, l2 = (reg_param if reg_type == t else 0.0 for t in ("L1", "L2"))
    with evaluations(rows, label, features, gradient, len(initial) if initial is not None else None) as (measure, width):
        start = initial if initial is not None else [0.0] * width
        return minimize(measure, start, l1, l2, num_iterations, memory, tolerance)
