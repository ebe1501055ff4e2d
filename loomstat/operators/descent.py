"""Gradient descent over DataFrame rows, with a loss and gradient given as Column expressions.

Step i uses s = step_size / sqrt(i) and the mean gradient over the batch, and stops once the
weights move by less than ``tolerance`` relative to their length (1 at least). Rows never leave the
executors: each step is one aggregate to d + 2 numbers, and the update is arithmetic on d numbers.
The weights enter the next step's plan as constants, so the plan does not grow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions import doubles
from loomstat.operators.partitions import held
from loomstat.operators.sampling import in_share
from loomstat.session import scratch_path

# (label, features, weights) -> (one gradient column per weight, loss column)
Gradient = Callable[[Column, list[Column], list[float]], tuple[list[Column], Column]]
# (weights, gradient, step, reg_param) -> (new weights, penalty of the new weights)
Updater = Callable[[np.ndarray, np.ndarray, float, float], tuple[np.ndarray, float]]


@dataclass(frozen=True)
class Descent:
    """Weights after the last step, and the loss seen at the start of each step."""

    weights: list[float]
    losses: list[float]


def margin(features: str | Sequence[str], weights: Sequence[float]) -> Column:
    """Score of a row: features are named columns, or one vector column."""
    if isinstance(features, str):
        known, vector = doubles(weights), F.unwrap_udt(features)
        dense = F.zip_with(vector["values"], known, lambda x, w: x * w)
        sparse = F.zip_with(vector["indices"], vector["values"], lambda i, x: x * F.get(known, i))
        products = F.when(vector["indices"].isNull(), dense).otherwise(sparse)
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)
    return dot([F.col(f) for f in features], weights)


def dot(features: Sequence[Column], weights: Sequence[float]) -> Column:
    """Sum of feature times weight, left to right."""
    total = features[0] * F.lit(float(weights[0]))
    for feature, weight in zip(features[1:], weights[1:]):
        total = total + feature * F.lit(float(weight))
    return total


@dataclass(frozen=True)
class LinearGradient:
    """A gradient that is a number per row times the row's features.

    ``pull(label, margin)`` gives that number and the loss; such gradients also work on vectors.
    """

    pull: Callable[[Column, Column], tuple[Column, Column]]

    def __call__(self, label: Column, features: list[Column], weights: list[float]):
        number, loss = self.pull(label, dot(features, weights))
        return [number * x for x in features], loss


def _squared_error(label: Column, margin: Column):
    error = margin - label
    return error, error * error / F.lit(2.0)


def _hinge(label: Column, margin: Column):
    side = label * F.lit(2.0) - F.lit(1.0)
    room = F.lit(1.0) - side * margin
    return F.when(room > 0, -side).otherwise(0.0), F.greatest(room, F.lit(0.0))


def _log_loss(label: Column, margin: Column):
    away = F.log1p(F.exp(-F.abs(margin)))
    share = F.when(margin >= 0, 1.0 / (1.0 + F.exp(-margin))).otherwise(F.exp(margin) / (1.0 + F.exp(margin)))
    return share - label, F.greatest(margin, F.lit(0.0)) + away - label * margin


least_squares = LinearGradient(_squared_error)
# Labels 0 and 1; the loss is minus the log probability of the label.
log_loss = LinearGradient(_log_loss)
# Labels 0 and 1; the loss is zero once a row lies on its side of the margin.
hinge = LinearGradient(_hinge)


def no_penalty(weights: np.ndarray, gradient: np.ndarray, step: float, reg_param: float):
    return weights - step * gradient, 0.0


def l1_penalty(weights: np.ndarray, gradient: np.ndarray, step: float, reg_param: float):
    """Step, then pull every weight towards zero by step * reg_param, stopping at zero."""
    moved = weights - step * gradient
    shrunk = np.sign(moved) * np.maximum(0.0, np.abs(moved) - step * reg_param) + 0.0
    return shrunk, reg_param * float(np.abs(shrunk).sum())


def l2_penalty(weights: np.ndarray, gradient: np.ndarray, step: float, reg_param: float):
    shrunk = weights * (1.0 - step * reg_param) - step * gradient
    return shrunk, 0.5 * reg_param * float(shrunk @ shrunk)


UPDATERS: dict[str, Updater] = {"NONE": no_penalty, "L1": l1_penalty, "L2": l2_penalty}

# A gram matrix of d features costs d * d / 2 aggregates in one pass, as columns up to this many features.
GRAM_LIMIT = 40
# Up to so many features the matrix is added up in numpy, one per task, and put together by blocks.
WIDE_GRAM_LIMIT = 2000
GRAM_BLOCK = 128


def descend(
    rows: DataFrame,
    label: str,
    features: str | Sequence[str],
    gradient: Gradient = least_squares,
    updater: str | Updater = "L2",
    step_size: float = 1.0,
    num_iterations: int = 100,
    reg_param: float = 0.1,
    batch_share: float = 1.0,
    batch_key: str | None = None,
    initial: Sequence[float] | None = None,
    tolerance: float = 0.001,
) -> Descent:
    """Run the loop; with ``batch_share`` below 1 each step sees its own repeatable sample.

    ``features`` names double columns, or one vector column of any width (linear gradients only).
    The sample is drawn by ``batch_key``, which should be unique per row. Least squares over all
    rows needs the data once, however many steps follow: its gradient and loss depend on it through
    the products of label and features alone. Rows with a NULL label or feature are left out. If not
    one step's sample holds a row, the share is too small for the table, and an error says so.
    """
    update = UPDATERS[updater] if isinstance(updater, str) else updater
    if batch_share < 1.0 and batch_key is None:
        raise ValueError("a sample per step needs batch_key")
    steps = (step_size, num_iterations, reg_param, tolerance)
    columns = [F.col(label).cast("double").alias("_label")]
    if batch_share < 1.0:
        columns.append(F.col(batch_key).alias("_key"))
    if isinstance(features, str):
        if not isinstance(gradient, LinearGradient):
            raise ValueError("a vector column needs a linear gradient")
        with held(rows.select(*columns, F.col(features).alias("_x"))) as kept:
            data = kept.dropna(subset=["_label", "_x"])
            width = len(initial) if initial is not None else _width(data)
            weights = np.array(initial if initial is not None else [0.0] * width, dtype=float)
            batch = _batches(data, batch_share, num_iterations)
            return _sampled(_loop(_from_vectors(batch, gradient), update, weights, *steps), batch_share)
    weights = np.array(initial if initial is not None else [0.0] * len(features), dtype=float)
    whole = gradient is least_squares and batch_share >= 1.0
    if whole and len(features) <= GRAM_LIMIT:
        complete = rows.dropna(subset=[label, *features])
        return _loop(_from_products(complete, label, features), update, weights, *steps)
    if whole and len(features) <= WIDE_GRAM_LIMIT:
        cells = F.array(*[F.col(c).cast("double") for c in [*features, label]])
        return _loop(_from_blocks(rows.select(cells.alias("_x")), len(features)), update, weights, *steps)
    named = [f"_x{j}" for j in range(len(features))]
    columns += [F.col(f).cast("double").alias(x) for f, x in zip(features, named)]
    with held(rows.select(*columns)) as kept:
        # filtered after they are held: a filter below would be worked out on the features' definitions
        batch = _batches(kept.dropna(subset=["_label", *named]), batch_share, num_iterations)
        return _sampled(_loop(_from_rows(batch, len(features), gradient), update, weights, *steps), batch_share)


@contextmanager
def evaluations(
    rows: DataFrame, label: str, features: str | Sequence[str], gradient: Gradient, width: int | None = None
) -> Iterator[tuple[Callable[[np.ndarray], tuple[np.ndarray, float] | None], int]]:
    """Holds the complete rows and gives a function from weights to (mean gradient, mean loss), one aggregate
    a call and None without rows, beside the number of weights."""
    target = F.col(label).cast("double").alias("_label")
    if isinstance(features, str):
        if not isinstance(gradient, LinearGradient):
            raise ValueError("a vector column needs a linear gradient")
        with held(rows.select(target, F.col(features).alias("_x"))) as kept:
            data = kept.dropna(subset=["_label", "_x"])
            measure = _from_vectors(lambda i: data, gradient)
            yield lambda weights: measure(weights, 1), width if width is not None else _width(data)
        return
    named = [f"_x{j}" for j in range(len(features))]
    with held(rows.select(target, *[F.col(f).cast("double").alias(x) for f, x in zip(features, named)])) as kept:
        data = kept.dropna(subset=["_label", *named])
        measure = _from_rows(lambda i: data, len(named), gradient)
        yield lambda weights: measure(weights, 1), len(named)


def _sampled(found: Descent, batch_share: float) -> Descent:
    if batch_share < 1.0 and not found.losses:
        raise ValueError(f"no step's sample of {batch_share} of the rows held a row")
    return found


def _loop(measure, update, weights, step_size, num_iterations, reg_param, tolerance) -> Descent:
    losses: list[float] = []
    _, penalty = update(weights, np.zeros_like(weights), 0.0, reg_param)
    for i in range(1, num_iterations + 1):
        found = measure(weights, i)
        if found is None:  # an empty sample moves nothing
            continue
        mean_gradient, loss = found
        losses.append(loss + penalty)
        moved, penalty = update(weights, mean_gradient, step_size / np.sqrt(i), reg_param)
        change = float(np.linalg.norm(moved - weights))
        weights = moved
        if len(losses) > 1 and change < tolerance * max(float(np.linalg.norm(weights)), 1.0):
            break
    return Descent([float(w) for w in weights], losses)


def _batches(data: DataFrame, batch_share: float, num_iterations: int) -> Callable[[int], DataFrame]:
    """The rows of each step: all of them, or its sample.

    Samples are dealt ahead for as many steps as fill about one copy of the table: one pass writes every row
    under the steps whose sample it is in, and a step reads its own files only. Many steps of small
    samples thus cost one pass, not one each.
    """
    if batch_share >= 1.0:
        return lambda i: data
    ahead = max(1, int(1 / batch_share))
    dealt: dict[int, DataFrame] = {}

    def batch(i: int) -> DataFrame:
        first = (i - 1) // ahead * ahead + 1
        if first not in dealt:
            dealt.clear()
            dealt[first] = _dealt(data, batch_share, first, min(num_iterations, first + ahead - 1))
        return dealt[first].filter(F.col("_step") == i).drop("_step")

    return batch


def _dealt(data: DataFrame, batch_share: float, first: int, last: int) -> DataFrame:
    """Every row once per step from ``first`` to ``last`` that samples it, written by step."""
    path = scratch_path(data.sparkSession, "batches")
    own = F.filter(F.sequence(F.lit(first), F.lit(last)), lambda i: in_share(batch_share, F.col("_key"), i))
    each = data.select("*", F.explode(own).alias("_step"))
    parts = max(1, round(data.rdd.getNumPartitions() * batch_share))  # files per step, as large as the table's
    spread = F.pmod(F.xxhash64("_key"), F.lit(parts))
    each.repartition(F.col("_step"), spread).write.partitionBy("_step").parquet(path)
    return data.sparkSession.read.schema(each.schema).parquet(path)


def _width(data: DataFrame) -> int:
    first = data.select("_x").head()
    return first["_x"].size if first else 0


def _from_vectors(batch, gradient):
    """Sums of number times vector by slot: each task adds up its slots, and these are added by slot
    number. A slot's sum is one row, so no task ever holds the whole gradient of all partitions."""
    vector = F.unwrap_udt("_x")
    dense = F.transform(vector["values"], lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    sparse = F.zip_with(vector["indices"], vector["values"], lambda i, x: F.struct(i.alias("i"), x.alias("x")))
    cells = F.when(vector["indices"].isNull(), dense).otherwise(sparse)
    nothing = F.struct(F.lit(-1).alias("i"), F.lit(0.0).alias("x"))

    def measure(weights: np.ndarray, i: int):
        number, loss = gradient.pull(F.col("_label"), margin("_x", [float(w) for w in weights]))
        scored = batch(i).select(cells.alias("_s"), number.alias("_c"), loss.alias("_l"))
        # slot -1 carries the row itself: its count and its loss
        each = scored.select("_c", "_l", F.explode(F.concat(F.array(nothing), "_s")).alias("_e"))
        own = F.col("_e.i") < 0
        found = each.groupBy(F.col("_e.i").alias("i")).agg(
            F.sum(F.when(own, F.col("_l")).otherwise(F.col("_c") * F.col("_e.x"))).alias("s"),
            F.sum(F.when(own, 1).otherwise(0)).alias("n"),
        ).collect()
        slots = {row["i"]: row for row in found}
        if -1 not in slots:
            return None
        n = slots[-1]["n"]
        sums = np.zeros_like(weights)
        for slot, row in slots.items():
            if slot >= 0:
                sums[slot] = row["s"]
        return sums / n, slots[-1]["s"] / n

    return measure


def _from_rows(batch, width, gradient):
    xs = [F.col(f"_x{j}") for j in range(width)]

    def measure(weights: np.ndarray, i: int):
        parts, loss = gradient(F.col("_label"), xs, [float(w) for w in weights])
        named = [F.sum(g).alias(f"g{j}") for j, g in enumerate(parts)]
        row = batch(i).agg(F.count(loss).alias("n"), F.sum(loss).alias("loss"), *named).collect()[0]
        if row["n"] == 0:
            return None
        return np.array([row[f"g{j}"] for j in range(len(parts))]) / row["n"], row["loss"] / row["n"]

    return measure


def _from_products(rows, label, features):
    d = len(features)
    cells = [F.col(f).cast("double") for f in features] + [F.col(label).cast("double")]
    pairs = [(a, b) for a in range(d + 1) for b in range(a, d + 1)]
    means = [F.avg(cells[a] * cells[b]).alias(f"p{a}_{b}") for a, b in pairs]
    row = rows.agg(F.count("*").alias("n"), *means).collect()[0]
    if row["n"] == 0:
        return lambda weights, i: None
    product = np.zeros((d + 1, d + 1))
    for a, b in pairs:
        product[a, b] = product[b, a] = row[f"p{a}_{b}"]
    return _measure_of(product)


def _measure_of(product: np.ndarray):
    """Mean gradient and loss of least squares from the mean products of features and label."""
    gram, cross, square = product[:-1, :-1], product[:-1, -1], product[-1, -1]

    def measure(weights: np.ndarray, i: int):
        pull = gram @ weights
        loss = (weights @ pull - 2.0 * weights @ cross + square) / 2.0
        return pull - cross, float(loss)

    return measure


def _from_blocks(rows: DataFrame, width: int):
    """The mean products of wide rows ``_x`` (features, then label) in one pass.

    Each task adds up the outer products of its rows and sends them as blocks; the sum over all tasks is
    taken per (block, cell), so no task holds more than one matrix of its own and a share of the blocks.
    """
    d = width + 1
    starts = range(0, d, GRAM_BLOCK)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((d, d))
        for batch in batches:
            flat = batch.column(0).flatten()
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, d)  # nulls come as NaN
            null = np.asarray(flat.is_null()).reshape(-1, d).any(1) | np.isnan(x).any(1)
            x = x[~null]
            n += len(x)
            total += x.T @ x
        cells = [(a, b, total[a : a + GRAM_BLOCK, b : b + GRAM_BLOCK].ravel()) for a in starts for b in starts if a <= b]
        cells.append((-1, -1, np.array([float(n)])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
             pa.array([c[2] for c in cells], pa.list_(pa.float64()))], ["a", "b", "cells"]
        )

    parts = rows.mapInArrow(work, "a int, b int, cells array<double>")
    each = parts.select("a", "b", F.posexplode("cells").alias("i", "v")).groupBy("a", "b", "i").agg(F.sum("v").alias("v"))
    product, n = np.zeros((d, d)), 0.0
    for r in each.collect():
        if r["a"] < 0:
            n = r["v"]
            continue
        wide = min(GRAM_BLOCK, d - r["b"])
        i, j = r["a"] + r["i"] // wide, r["b"] + r["i"] % wide
        product[i, j] = product[j, i] = r["v"]
    if not n:
        return lambda weights, i: None
    return _measure_of(product / n)


def linear_regression(
    rows: DataFrame,
    label: str,
    features: str | Sequence[str],
    num_iterations: int = 100,
    step_size: float = 1.0,
    reg_type: str = "L2",
    reg_param: float = 0.1,
    tolerance: float = 0.001,
) -> Descent:
    """Least squares without intercept; ``reg_type`` is NONE, L1 or L2."""
    return descend(
        rows, label, features, least_squares, reg_type, step_size, num_iterations, reg_param,
        tolerance=tolerance,
    )


def linear_svm(
    rows: DataFrame,
    label: str,
    features: str | Sequence[str],
    num_iterations: int = 100,
    step_size: float = 1.0,
    reg_type: str = "L1",
    reg_param: float = 0.1,
    tolerance: float = 0.001,
) -> Descent:
    """Hinge loss without intercept on labels 0 and 1; the score is the raw margin."""
    return descend(
        rows, label, features, hinge, reg_type, step_size, num_iterations, reg_param,
        tolerance=tolerance,
    )
