"""Alternating least squares with normal equations that are summed in parts.

One half-step solves, for every user, ``(sum f f' + reg n I) x = sum r f`` over the factors f of the items
that the user rated, and the other half-step does the same for items. A user's sums are taken per (user,
part), with at most about ``PART_RATINGS`` ratings in a part, and parts are added up before the solve, so a
user or an item with a third of all ratings is spread over tasks. Only such keys have parts; all
others are solved where their ratings lie, after one shuffle.

Implicit ratings are confidences: ``c = alpha |r|``, preferred where r > 0. Each half-step then solves
``(Y'Y + sum c f f' + reg n I) x = sum over preferred (1 + c) f``, where ``Y'Y``, the Gram matrix of all
factors, is one global sum, and only the observed pairs add corrections to it; n counts the preferred.

Starts are hashes of the ids, so a fit is the same in every run and under every partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.operators.joins import join_lookup
from loomstat.operators.relational import mean_per_pair
from loomstat.operators.sampling import BUCKETS, key_bucket
from loomstat.session import scratch_path

PART_RATINGS = 1_000_000
CELLS = 2_000_000  # numbers in the products that a task holds at a time

USER, ITEM = "user", "product"


@dataclass(frozen=True)
class FactorModel:
    """Factors as tables ``id, features``; the names are those of the library's model."""

    rank: int
    userFactors: DataFrame
    itemFactors: DataFrame


def start_factors(ids: DataFrame, rank: int, seed: int = 0) -> DataFrame:
    """``id, features`` for a column ``id``: uniform numbers from the id's hash, divided by sqrt(rank)."""
    def one(j: int) -> Column:
        return key_bucket(F.lit(seed), F.col("id"), F.lit(j)) / F.lit(BUCKETS * rank**0.5)

    return ids.select("id", F.array(*[one(j) for j in range(rank)]).alias("features"))


def with_parts(ratings: DataFrame, by: str, other: str, part_ratings: int) -> DataFrame:
    """Add ``part, parts``: a key of more than ``part_ratings`` ratings is dealt by its partner's hash.

    Only such keys are looked up, and there are at most as many as the ratings fill parts.
    """
    heavy = ratings.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("_n")).filter(F.col("_n") > part_ratings)
    found = ratings.join(F.broadcast(heavy), ratings[by] == F.col("_by"), "left")
    parts = F.coalesce(F.ceil(F.col("_n") / part_ratings), F.lit(1)).cast("int")
    placed = found.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64(other), F.col("parts")).cast("int"))
    return placed.drop("_by", "_n")


def gram(factors: DataFrame, rank: int) -> np.ndarray:
    """Sum of the outer products of all factors: each task adds up its own, the driver gets rank * rank sums."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank, rank))
        for batch in batches:
            f = _matrix(batch.column(0), rank)
            total += f.T @ f
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["g"])

    cells = factors.select("features").mapInArrow(work, "g array<double>").select(F.posexplode("g").alias("i", "v"))
    out = np.zeros(rank * rank)
    for row in cells.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[row["i"]] = row["v"]
    return out.reshape(rank, rank)


def _matrix(column: pa.Array, rank: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)


def _equations(f: np.ndarray, rating: np.ndarray, implicit: bool, alpha: float) -> np.ndarray:
    """Per rating: upper triangle of its outer product, its right side, and what it adds to n."""
    i, j = np.triu_indices(f.shape[1])
    if implicit:
        weight = alpha * np.abs(rating)
        likes = rating > 0
        right = np.where(likes, 1.0 + weight, 0.0)
    else:
        weight, right, likes = np.ones(len(f)), rating, np.ones(len(f))
    return np.concatenate([f[:, i] * f[:, j] * weight[:, None], f * right[:, None], likes[:, None]], axis=1)


def _solutions(sums: np.ndarray, rank: int, reg_param: float, base: np.ndarray) -> np.ndarray:
    """Solves a stack of packed equations; ``base`` is added to every matrix."""
    i, j = np.triu_indices(rank)
    half = len(i)
    a = np.empty((len(sums), rank, rank))
    a[:, i, j] = a[:, j, i] = sums[:, :half]
    a += base + reg_param * sums[:, -1][:, None, None] * np.eye(rank)
    return _solve(a, sums[:, half:-1])


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solves a stack of equations."""
    b = b[:, :, None]
    try:
        return np.linalg.solve(a, b)[:, :, 0]
    except np.linalg.LinAlgError:  # without regularisation a matrix may be singular: least norm
        return (np.linalg.pinv(a, hermitian=True) @ b)[:, :, 0]


def half_step(
    ratings: DataFrame,
    factors: DataFrame,
    rank: int,
    reg_param: float,
    implicit: bool = False,
    alpha: float = 1.0,
    by: str = USER,
    other: str = ITEM,
    part_ratings: int = PART_RATINGS,
) -> DataFrame:
    """``id, features`` of every value of ``by`` that has ratings, from the ``factors`` of ``other``.

    ``ratings`` has one row per pair. Pairs whose other side has no factors are left out.
    """
    base = gram(factors, rank) if implicit else np.zeros((rank, rank))
    known = factors.select(F.col("id").alias(other), F.col("features").alias("_f"))
    rows = ratings.select(by, other, F.col("rating").cast("double").alias("rating"))
    rows = with_parts(rows, by, other, part_ratings)
    met = join_lookup(rows, known, other, F.col(by), 8 * rank + 32)
    met = met.select(F.col(by).alias("id"), "part", "parts", "rating", "_f")
    placed = met.repartition("id", "part").sortWithinPartitions("id", "part")
    step = max(1, CELLS // (rank * (rank + 3) // 2 + 1))
    kind = met.schema["id"].dataType.simpleString()
    names = ["id", "features", "sums"]

    def rows_of(keys: list, sums: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
        whole = parts == 1
        solved = _solutions(sums[whole], rank, reg_param, base) if whole.any() else np.zeros((0, rank))
        place = np.cumsum(whole) - 1
        features = [solved[place[k]] if whole[k] else None for k in range(len(keys))]
        left = [None if whole[k] else sums[k] for k in range(len(keys))]
        doubles = pa.list_(pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(features, doubles), pa.array(left, doubles)], names)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the group that may go on in the next rows: key, part, parts, sums
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                key, part, parts = (rows.column(c).to_numpy(zero_copy_only=False) for c in range(3))
                cells = _equations(_matrix(rows.column(4), rank), rows.column(3).to_numpy(), implicit, alpha)
                begins = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
                sums = np.add.reduceat(cells, begins, axis=0)
                ids, of, many = key[begins], part[begins], parts[begins]
                if last is not None:
                    if (last[0], last[1]) == (ids[0], of[0]):
                        sums[0] += last[3]
                    else:
                        yield rows_of([last[0]], last[3][None], np.array([last[2]]))
                last = ids[-1], of[-1], many[-1], sums[-1]
                if len(ids) > 1:
                    yield rows_of(list(ids[:-1]), sums[:-1], many[:-1])
        if last is not None:
            yield rows_of([last[0]], last[3][None], np.array([last[2]]))

    def finished(group: pa.Table) -> pa.Table:
        total = np.sum(group.column("sums").to_pylist(), axis=0)[None]
        solved = _solutions(total, rank, reg_param, base)
        return pa.table({"id": group.column("id").slice(0, 1), "features": pa.array(list(solved), pa.list_(pa.float64()))})

    path = scratch_path(ratings.sparkSession, "factors")
    placed.mapInArrow(summed, f"id {kind}, features array<double>, sums array<double>").write.parquet(path)
    found = ratings.sparkSession.read.parquet(path)
    split = found.filter(F.col("features").isNull()).select("id", "sums")  # one row per part of a heavy key
    done = split.groupBy("id").applyInArrow(finished, f"id {kind}, features array<double>")
    return found.filter(F.col("features").isNotNull()).select("id", "features").unionAll(done)


def factorize(
    ratings: DataFrame,
    rank: int = 10,
    num_iterations: int = 20,
    reg_param: float = 1.0,
    implicit: bool = False,
    alpha: float = 1.0,
    seed: int = 0,
    part_ratings: int = PART_RATINGS,
) -> FactorModel:
    """Fit ``user, product, rating``; repeated pairs are averaged, rows with a null are left out.

    The averaged pairs and the factors of every half-step are written to the shared folder, so neither
    the plan nor what a lost executor costs grows with the iterations.
    """
    spark = ratings.sparkSession
    path = scratch_path(spark, "pairs")
    mean_per_pair(ratings.dropna(subset=[USER, ITEM, "rating"]), [USER, ITEM]).write.parquet(path)
    pairs = spark.read.parquet(path)

    def kept(frame: DataFrame) -> DataFrame:
        at = scratch_path(spark, "factors")
        frame.write.parquet(at)
        return spark.read.parquet(at)

    users = kept(start_factors(pairs.select(F.col(USER).alias("id")).distinct(), rank, seed))
    items = kept(start_factors(pairs.select(F.col(ITEM).alias("id")).distinct(), rank, seed + 1))
    for _ in range(num_iterations):
        items = kept(half_step(pairs, users, rank, reg_param, implicit, alpha, ITEM, USER, part_ratings))
        users = kept(half_step(pairs, items, rank, reg_param, implicit, alpha, USER, ITEM, part_ratings))
    return FactorModel(rank, users, items)
