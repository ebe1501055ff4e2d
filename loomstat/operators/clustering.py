"""k-means: the library fit, steps from given centers, assignment and cost."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.operators.partitions import held
from loomstat.operators.sampling import BUCKETS, key_bucket

INIT_MODES = {"Random": "random", "Parallel": "k-means||"}
# A center whose squared distance is within this share of the least one is as near; the lowest number wins.
NEAR = 1e-9
# Up to so many center coordinates go into the plan one by one; more as one array constant, with the same result.
FLAT_CELLS = 64

Centers = Sequence[Sequence[float]]


def fit_kmeans(
    rows: DataFrame, k: int = 3, num_iterations: int = 10, init_mode: str = "Parallel", seed: int | None = None
):
    """k-means on a vector column ``features``; the start is random."""
    if init_mode not in INIT_MODES:
        raise ValueError(f"unknown init_mode {init_mode}: use Random or Parallel")
    model = KMeans(k=k, maxIter=num_iterations, initMode=INIT_MODES[init_mode])
    with held(rows) as data:
        return (model.setSeed(seed) if seed is not None else model).fit(data)


def _distances(point: Sequence[str] | str, centers: Centers) -> list[Column] | Column:
    """Squared distances to all centers: columns while these are few, else one array column."""
    if not isinstance(point, str) and len(centers) * len(point) <= FLAT_CELLS:
        out = []
        for center in centers:
            gaps = [F.col(d) - F.lit(float(c)) for d, c in zip(point, center)]
            out.append(sum((g * g for g in gaps), F.lit(0.0)))
        return out
    own = F.col(point) if isinstance(point, str) else F.array(*[F.col(d).cast("double") for d in point])
    known = F.lit(np.array(centers, dtype=float).ravel())
    width = len(centers[0])

    def distance(i: Column) -> Column:
        squares = F.zip_with(own, F.slice(known, i * width + 1, F.lit(width)), lambda p, c: (p - c) * (p - c))
        return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)

    return F.transform(F.sequence(F.lit(0), F.lit(len(centers) - 1)), distance)


def nearest(point: Sequence[str] | str, centers: Centers) -> Column:
    """Number of the nearest center; ``point`` names numeric columns, or one array column."""
    found = _distances(point, centers)
    if isinstance(found, Column):
        first = F.transform(  # bind the array to a variable, or it is worked out again per element
            F.array(found),
            lambda ds: F.array_position(F.transform(ds, lambda d: d <= F.array_min(ds) * (1 + NEAR)), True) - 1,
        )
        return F.get(first, F.lit(0)).cast("int")
    bound = (found[0] if len(found) == 1 else F.least(*found)) * (1 + NEAR)
    chosen = F.when(found[0] <= bound, 0)
    for i, d in enumerate(found[1:], start=1):
        chosen = chosen.when(d <= bound, i)
    return chosen


def assign(rows: DataFrame, point: Sequence[str] | str, centers: Centers) -> DataFrame:
    """Add each row's ``cluster``. Centers are few and go into the plan as constants."""
    return rows.withColumn("cluster", nearest(point, centers))


def cost(rows: DataFrame, point: Sequence[str] | str, centers: Centers) -> DataFrame:
    """Sum of squared distances to the nearest center."""
    return rows.agg(F.sum(_least_distance(point, centers)).alias("cost"))


def lloyd(
    rows: DataFrame, dims: Sequence[str], start: Centers, num_iterations: int = 10
) -> list[list[float]]:
    """Move the centers ``num_iterations`` times; a center without rows stays where it is.

    A step is one aggregate to k rows, combined before the shuffle, so a cluster with most of the
    rows costs no more than a small one.
    """
    centers = [[float(c) for c in center] for center in start]
    points = rows.select(*[F.col(d).cast("double").alias(d) for d in dims])
    with held(points) as points:
        for _ in range(num_iterations):
            step = assign(points, dims, centers).groupBy("cluster").agg(*[F.avg(d).alias(d) for d in dims])
            moved = [list(c) for c in centers]
            for row in step.collect():
                moved[row["cluster"]] = [row[d] for d in dims]
            if moved == centers:
                break
            centers = moved
    return centers


def oversampled_seeds(
    rows: DataFrame, dims: Sequence[str], key: str, k: int, rounds: int = 5, per_round: float | None = None, seed: int = 0
) -> list[list[float]]:
    """``k`` starting centers by oversampling: a few rounds that draw many, then a weighted choice of k.

    The first candidate is the point with the least hash. Each round draws every point with the
    probability ``per_round`` (default 2k) times its share of the squared distance to the candidates so
    far. Draws are hashes of ``key``, which should be unique per row, and the round, so they depend on no
    partitioning. Every candidate then weighs as many points as are nearest to it, the heaviest is the
    first center, and each further center is the candidate of the largest weight times squared distance
    to the centers chosen (lowest key among equals). Candidates are some ``per_round * rounds`` rows; only
    they leave the executors. Rows with a null key or coordinate are left out; fewer distinct points
    than k give fewer centers.
    """
    per_round = 2.0 * k if per_round is None else float(per_round)
    points = rows.select(F.col(key).alias("_k"), *[F.col(d).cast("double").alias(d) for d in dims])
    with held(points) as kept:
        data = kept.dropna(subset=["_k", *dims])

        def draw(r: int) -> Column:
            return key_bucket(F.lit(seed), F.lit(r), F.col("_k"))

        first = data.orderBy(draw(0), "_k").limit(1).collect()
        chosen = {row["_k"]: [row[d] for d in dims] for row in first}
        for r in range(1, rounds + 1) if chosen else ():
            near = _least_distance(dims, list(chosen.values()))
            total = data.agg(F.sum(near).alias("t")).first()["t"]
            if not total:
                break
            share = near * F.lit(per_round / total)
            for row in data.filter(draw(r) / F.lit(float(BUCKETS)) < share).collect():
                chosen[row["_k"]] = [row[d] for d in dims]
        keys = sorted(chosen)
        centers = np.array([chosen[c] for c in keys], dtype=float).reshape(len(keys), len(dims))
        weight = np.zeros(len(keys))
        if keys:
            for row in assign(data, dims, centers.tolist()).groupBy("cluster").count().collect():
                weight[row["cluster"]] = row["count"]
    picked: list[int] = []
    worth = weight
    while len(picked) < min(k, len(keys)) and worth.max() > 0:
        picked.append(int(np.argmax(worth)))
        away = ((centers[:, None] - centers[picked][None]) ** 2).sum(2).min(1)
        worth = weight * away
    return centers[picked].tolist()


def _least_distance(point: Sequence[str] | str, centers: Centers) -> Column:
    found = _distances(point, centers)
    if isinstance(found, Column):
        return F.array_min(found)
    return found[0] if len(found) == 1 else F.least(*found)
