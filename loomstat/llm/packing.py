"""Packing pieces of documents into sequences of several permitted lengths by best fit.

A text longer than the longest sequence is cut into full pieces and a rest. Pieces are packed within
groups of bounded size, in parallel. In a group pieces go from long to short, each into the open
sequence that it leaves the least room in. If none has room, a sequence is opened: of the permitted
lengths the one that costs least for each unit that the pieces still to come can fill. In the end
every sequence is cut down to the cheapest permitted length that holds its contents. Three ways of
opening (least cost, shortest, longest) are tried and the group's cheapest result is kept, so that
the lengths are chosen together and not piece by piece alone.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.session import scratch_path

CAPACITIES = (2_048, 4_096, 8_192, 16_384)
GROUP_PIECES = 20_000


def sequence_cost(capacity: int) -> float:
    """What computing one sequence costs: its length, an attention term, and a fixed part."""
    return capacity + capacity * capacity / 65_536 + 32


def best_fit(
    lengths: Sequence[int],
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sequence number and offset of each piece, and the sequences' final lengths.

    Lengths are from 1 to the largest capacity. Of the three ways of opening, the cheapest wins, the
    first named at equal cost; equal pieces keep their order.
    """
    sizes = sorted(capacities)
    best = None
    for way in ("least", "shortest", "longest"):
        found = _fit(lengths, sizes, cost, way)
        total = sum(cost(c) for c in found[2])
        if best is None or total < best[0]:
            best = total, found
    return best[1]


def _fit(lengths: Sequence[int], sizes: list[int], cost: Callable[[int], float], way: str):
    order = np.argsort(-np.asarray(lengths, np.int64), kind="stable")
    bin_of, offset = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (free, sequence), sorted
    to_come = int(np.sum(lengths))
    for at in order:
        n = int(lengths[at])
        spot = bisect_left(room, (n, -1))
        if spot < len(room):
            free, b = room.pop(spot)
        else:
            fitting = [c for c in sizes if c >= n]
            if way == "least":
                size = min(fitting, key=lambda c: (cost(c) / min(c, to_come), c))
            else:
                size = fitting[0] if way == "shortest" else fitting[-1]
            free, b = size, len(used)
            used.append(0)
        bin_of[at], offset[at] = b, used[b]
        used[b] += n
        to_come -= n
        if free > n:
            insort(room, (free - n, b))
    final = [min((c for c in sizes if c >= u), key=lambda c: (cost(c), c)) for u in used]
    return bin_of, offset, final


def pieces(rows: DataFrame, longest: int) -> DataFrame:
    """Rows with ``size`` cut into ``piece, start, length``; a size of 0 gives one piece of length 0."""
    count = F.greatest(F.ceil(F.col("size") / longest), F.lit(1))
    cut = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)).alias("piece"))
    start = F.col("piece") * longest
    length = F.least(F.lit(longest).cast("long"), F.col("size") - start)
    return cut.withColumns({"start": start, "length": length}).drop("size")


def pack(
    docs: DataFrame,
    size: Column,
    key: str = "doc_id",
    group: Column | None = None,
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
) -> DataFrame:
    """``key, piece, start, length, bin_id, capacity, offset`` for every piece of every row.

    ``size`` gives a row's length in tokens; null counts as 0. A row of size 0 needs no room: one
    piece without a sequence. ``group`` may name rows to be packed together (consecutive rows of a
    mix), each of bounded size; without it pieces are dealt at random into groups of about 20,000,
    whatever their keys repeat. The sizes are written before they are dealt, so that a retry deals
    alike. An empty table gives no rows; other columns are not read.
    """
    sizes = sorted(set(capacities))
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).alias("k"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        (group if group is not None else F.lit(None)).cast("string").alias("g"),
        F.monotonically_increasing_id().alias("n"),
    )
    path = scratch_path(spark, "pieces")
    pieces(rows, sizes[-1]).write.parquet(path)
    cut = spark.read.parquet(path)
    groups = max(1, -(-cut.count() // GROUP_PIECES))
    dealt = F.pmod(F.xxhash64("n", "piece"), F.lit(groups)).cast("string")
    cut = cut.withColumn("g", F.coalesce("g", dealt))
    some = cut.filter(F.col("length") > 0)

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "n", "piece"], ascending=[False, True, True], kind="stable")
        bins, offset, final = best_fit(frame["length"].to_numpy(), sizes, cost)
        name = frame["g"].iloc[0]
        return frame[["k", "piece", "start", "length"]].assign(
            bin_id=[f"{name}-{b}" for b in bins], capacity=np.array(final, np.int64)[bins], offset=offset
        )

    schema = f"k {cut.schema['k'].dataType.simpleString()}, piece long, start long, length long, bin_id string, capacity long, offset long"
    packed = some.groupBy("g").applyInPandas(work, schema)
    empty = cut.filter(F.col("length") == 0).select(
        "k", "piece", "start", "length", F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("long")
    )
    return packed.union(empty).withColumnRenamed("k", key)
