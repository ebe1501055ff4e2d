"""Alternating least squares whose half-steps read the other side's factors instead of being sent them.

The keys of a side are dealt to blocks by hash, and each block's ratings are written once, in the order in which
they are needed. A half-step has one task per block. It reads its ratings, then the factors of the other side
chunk by chunk, and adds every chunk to the equations of its keys; the solved factors are written as one chunk of
the next half-step. Nothing is shuffled between half-steps, so what a fit writes grows with its factors, where
sending each factor to every block that rates it grows with the blocks too. A task holds its block's ratings and
equations and one batch of factors, and the number of blocks bounds the first two.

Factors are kept as single precision and the equations summed in double precision, as in the library's fit.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.operators.factorize import CELLS, ITEM, USER, _solve, gram
from loomstat.session import delete_path, scratch_path

BLOCK_BYTES = 400_000_000  # of ratings with their partners' factors that a task holds; one key's are never parted
PIECE_RATINGS = 1_000_000  # ratings in one row of a layout

CHUNK = "block int, ids binary, features binary"
PIECE = "part int, keys binary, counts binary, others binary, places binary, ratings binary"


def block_count(ratings: int, rank: int, cores: int) -> int:
    """Blocks whose ratings fit into a task, in whole rounds of the cores."""
    return -(-max(10, -(-ratings * (4 * rank + 32) // BLOCK_BYTES)) // cores) * cores


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def chunked(factors: DataFrame, blocks: int) -> DataFrame:
    """``block, ids, features``: the factors of each block in one row, ordered by id."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0)[0].as_py(), b.column(1).to_numpy(), b.column(2).flatten().to_numpy()) for b in batches if b.num_rows]
        if held:
            yield _chunk(held[0][0], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]))

    rows = factors.select(F.col("id").cast("int").alias("id"), F.col("features").cast("array<float>").alias("features"))
    placed = rows.repartitionById(blocks, _block("id", blocks)).select(_block("id", blocks).alias("block"), "id", "features")
    return placed.sortWithinPartitions("id").mapInArrow(packed, CHUNK)


def _chunk(block: int, ids: np.ndarray, features: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([block], pa.int32()), pa.array([ids.astype(np.int32).tobytes()]), pa.array([features.astype(np.float32).tobytes()])]
    return pa.RecordBatch.from_arrays(cells, ["block", "ids", "features"])


def unchunked(chunks: DataFrame, rank: int) -> DataFrame:
    """``id, features``, one row per key."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, f = _numbers(batch, 0, k, np.int32), _numbers(batch, 1, k, np.float32)
                for at in range(0, len(ids), 10_000):
                    some = pa.array(f[at * rank : (at + 10_000) * rank])
                    starts = pa.array(np.arange(0, len(some) + 1, rank, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 10_000]), pa.ListArray.from_arrays(starts, some)], ["id", "features"])

    return chunks.select("ids", "features").mapInArrow(rows, "id int, features array<float>")


def _numbers(batch: pa.RecordBatch, column: int, row: int, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), kind)


def laid_out(pairs: DataFrame, by: str, other: str, blocks: int) -> tuple[str, list[DataFrame]]:
    """The ratings of each block of ``by`` in pieces of one part (block of ``other``) each, ordered by key.

    Returns the folder, and per block its pieces, as the first rows that ``half_step`` reads. A piece names its keys
    with their numbers of ratings, and the partners once, by whose places the ratings find them.
    """
    spark = pairs.sparkSession

    def piece(rows: list[list[np.ndarray]]) -> pa.RecordBatch:
        block, part, key, other, rating = (np.concatenate(c) for c in zip(*rows, strict=True))
        order = np.lexsort((other, key))
        key, other, rating = key[order], other[order], rating[order]
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        others, places = np.unique(other, return_inverse=True)
        counts = np.diff(np.r_[begins, len(key)])
        cells = [pa.array([int(part[0])], pa.int32())]
        cells += [pa.array([c.astype(np.int32).tobytes()]) for c in (key[begins], counts, others, places)]
        cells += [pa.array([rating.astype(np.float32).tobytes()]), pa.array([int(block[0])], pa.int32())]
        return pa.RecordBatch.from_arrays(cells, ["part", "keys", "counts", "others", "places", "ratings", "block"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            cuts = [0, *np.flatnonzero(np.diff(columns[1])) + 1, batch.num_rows]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                if first == last:
                    continue
                rows = [c[first:last] for c in columns]
                if held and (held[-1][1][-1] != rows[1][0] or n >= PIECE_RATINGS):
                    yield piece(held)
                    held, n = [], 0
                held.append(rows)
                n += last - first
        if held:
            yield piece(held)

    key, partner = F.col(by).cast("int").alias("key"), F.col(other).cast("int").alias("other")
    rows = pairs.select(key, partner, F.col("rating").cast("float").alias("rating"))
    placed = rows.repartitionById(blocks, _block("key", blocks))
    named = placed.select(_block("key", blocks).alias("block"), _block("other", blocks).alias("part"), "key", "other", "rating")
    path = scratch_path(spark, "layout")
    named.sortWithinPartitions("part").mapInArrow(packed, f"{PIECE}, block int").write.partitionBy("block").parquet(path)
    sizes = spark.read.schema(f"{PIECE}, block int").parquet(path).groupBy("block").agg(F.count("*").alias("n")).collect()
    no_chunk = [F.lit(None).cast("binary").alias(c) for c in ("ids", "features")]
    streams = []
    for block, of in sorted(sizes):
        own = spark.read.schema(PIECE).parquet(f"{path}/block={block}")
        streams.append(own.select(F.lit(block).alias("block"), F.lit(of).alias("of"), *own.columns, *no_chunk).coalesce(1))
    return path, streams


def half_step(
    layout: list[DataFrame], chunks: DataFrame, rank: int, reg_param: float, implicit: bool = False, alpha: float = 1.0
) -> DataFrame:
    """The factors of every key of the layout, as chunks, from the ``chunks`` of the other side."""
    base = gram(unchunked(chunks, rank).select(F.col("features").cast("array<double>")), rank) if implicit else np.zeros((rank, rank))

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, waiting, met, of, block = [], [], None, None, None

        def meet(part: int, ids: np.ndarray, features: np.ndarray) -> None:
            """Puts the factors of a chunk beside the ratings of its part."""
            for at, (own, _, _, others, places, _) in zip(begins, pieces, strict=True):
                if own == part:
                    met[at : at + len(places)] = features.reshape(-1, rank)[np.searchsorted(ids, others)[places]]

        for batch in batches:
            for k in range(batch.num_rows):
                number = batch.column(2)[k].as_py()
                if batch.column(1)[k].is_valid:
                    block, of = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                    cells = [_numbers(batch, c, k, np.int32) for c in range(3, 7)]
                    pieces.append((number, *cells, _numbers(batch, 7, k, np.float32)))
                else:
                    waiting.append((number, _numbers(batch, 8, k, np.int32), _numbers(batch, 9, k, np.float32)))
                if len(pieces) == of:  # all are there; the chunks come after them, unless files are read in another order
                    if met is None:
                        begins = np.cumsum([0, *[len(p[4]) for p in pieces]])
                        met, begins = np.empty((begins[-1], rank), np.float32), begins[:-1]
                    while waiting:
                        meet(*waiting.pop())
        if of is not None:
            names, counts, ratings = (np.concatenate([p[c] for p in pieces]) for c in (1, 2, 5))
            keys, place = np.unique(names, return_inverse=True)
            yield _chunk(block, keys, _factors(np.repeat(place, counts), met, ratings, reg_param, implicit, alpha, base))

    none = [F.lit(None).cast("binary").alias(c) for c in ("keys", "counts", "others", "places", "ratings")]
    every = chunks.select(F.lit(-1).alias("block"), F.lit(None).cast("int").alias("of"), F.col("block").alias("part"), *none, "ids", "features")
    once = every.coalesce(1)
    streams = [pieces.unionAll(once).coalesce(1) for pieces in layout]
    # a union whose parts are all single partitions would put them together, so one part is another: it has no rows
    streams.append(every.filter(F.col("part") < 0).coalesce(2))
    return functools.reduce(DataFrame.unionAll, streams).mapInArrow(solved, CHUNK)


def _factors(
    key: np.ndarray, f: np.ndarray, rating: np.ndarray, reg_param: float, implicit: bool, alpha: float, base: np.ndarray
) -> np.ndarray:
    """Per key, numbered from 0, the solution of its equations; rows of ``f`` belong to the ratings beside them.

    Keys of the same number of ratings are multiplied together, some ``CELLS`` numbers at a time.
    """
    rank = f.shape[1]
    order, counts = np.argsort(key, kind="stable"), np.bincount(key)
    starts = np.cumsum(counts) - counts
    out = np.empty((len(counts), rank), np.float32)
    most = max(1, CELLS // rank)  # ratings at a time

    def sums(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        left, r = f[rows].astype(np.float64), rating[rows].astype(np.float64)
        across = left.transpose(0, 2, 1)
        if not implicit:
            return across @ left, (across @ r[:, :, None])[:, :, 0], np.full(len(rows), float(rows.shape[1]))
        weight, likes = alpha * np.abs(r), r > 0
        right = np.where(likes, 1.0 + weight, 0.0)
        return (across * weight[:, None, :]) @ left, (across @ right[:, :, None])[:, :, 0], likes.sum(axis=1).astype(float)

    by_count = np.argsort(counts, kind="stable")
    ends = np.flatnonzero(np.diff(counts[by_count])) + 1
    for same in np.split(by_count, ends):
        many = counts[same[0]]
        for at in range(0, len(same), max(1, most // many)):
            some = same[at : at + max(1, most // many)]
            cuts = [(first, min(many, first + most)) for first in range(0, many, most)]
            parts = [sums(order[starts[some][:, None] + np.arange(*cut)]) for cut in cuts]
            a, b, n = (functools.reduce(np.add, x) for x in zip(*parts, strict=True))
            out[some] = _solve(a + base + (reg_param * n)[:, None, None] * np.eye(rank), b)
    return out


def iterate(
    pairs: DataFrame,
    users: DataFrame,
    rank: int,
    num_iterations: int,
    reg_param: float,
    implicit: bool,
    alpha: float,
    blocks: int,
) -> tuple[DataFrame, DataFrame]:
    """Factors of users and items after some iterations from the users' start; ``pairs`` has one row per pair.

    Both sides have as many blocks. Tables of earlier half-steps are deleted as soon as the next one is written.
    """
    spark = pairs.sparkSession
    of_users, by_user = laid_out(pairs, USER, ITEM, blocks)
    of_items, by_item = laid_out(pairs, ITEM, USER, blocks)
    paths: list[str] = []

    def kept(chunks: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "factors"))
        chunks.write.parquet(paths[-1])
        for old in paths[:-2]:
            delete_path(spark, old)
        del paths[:-2]
        return spark.read.schema(CHUNK).parquet(paths[-1])

    found = kept(chunked(users, blocks))
    for _ in range(num_iterations):
        items = kept(half_step(by_item, found, rank, reg_param, implicit, alpha))
        found = kept(half_step(by_user, items, rank, reg_param, implicit, alpha))
    for path in (of_users, of_items):
        delete_path(spark, path)
    return unchunked(found, rank), unchunked(items, rank)
