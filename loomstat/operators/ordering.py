"""Global order: top-k, row numbers over a whole table, and ordered chunks of bounded size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomstat.functions import doubles
from loomstat.session import ensure_checkpoint_dir

# monotonically_increasing_id() keeps the row within its partition in the low 33 bits.
ROW_BITS = 33


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows in this order; each task keeps k rows only."""
    return df.orderBy(*order).limit(k)


def with_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Number all rows from 1 in a global order without moving them into one partition.

    The sorted rows are written once (a second sort could cut its ranges elsewhere); then only one
    row per partition is needed to know how many rows stand before it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    slot = F.col("_slot")
    placed = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("_part", F.shiftright(slot, ROW_BITS))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    # one row per partition, so neither the window nor the broadcast grows with the table
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = slot.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_start") + within + 1).alias(name))


def order_number(df: DataFrame, name: str) -> Column:
    """A double that never falls where the column rises (seconds are enough for time columns)."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        return (F.unix_date(F.to_date(column)).cast("double") * 86400) + seconds
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    raise TypeError(f"cannot cut {kind.simpleString()} column {name} into ordered chunks")


CHUNK_ROWS = 2_000_000


def chunk_count(df: DataFrame, chunk_rows: int = CHUNK_ROWS) -> int:
    """How many chunks of about ``chunk_rows`` rows the table makes."""
    return max(1, math.ceil(df.count() / chunk_rows))


def with_ordered_chunks(
    df: DataFrame, order: str, tie: str | None, chunks: int, name: str = "chunk"
) -> DataFrame:
    """Add a chunk number that rises with ``(order, tie)``, about the same number of rows in each.

    A window over (key, chunk) instead of (key) then never sees more than about one chunk, even if
    one key holds most of the table. The cuts are approximate quantiles of the whole table, fetched
    once and used as constants, so every task and every retry cuts alike. A single order value with
    several chunks' worth of rows is cut again by ``tie``.
    """
    position = order_number(df, order)  # refuses a type at every size, not only where it is cut
    if chunks <= 1:
        return df.withColumn(name, F.lit(0).cast("long"))
    cuts = _quantiles(df.select(position.alias("v")), chunks)
    weight = {a: 1 + cuts.count(a) for a, b in zip(cuts, cuts[1:]) if a == b}
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol="_v", outputCol="_bucket", handleInvalid="keep")
    placed = bucketizer.transform(df.withColumn("_v", position))
    # between two buckets there is room for the sub-chunks of one heavy value, and the rest after them
    bucket = F.col("_bucket").cast("long") * F.lit(2 * chunks + 2).cast("long")
    if weight and tie is not None:
        bucket = bucket + _tie_step(df, placed, tie, weight, chunks + 1)
    # missing order values come first, as in a window; a chunk that is never NULL also spares the
    # joins on it a check, so that scans of the same rows stay alike and are shared
    return placed.withColumn(name, F.coalesce(bucket, F.lit(-1).cast("long"))).drop("_v", "_bucket")


def _quantiles(values: DataFrame, chunks: int) -> list[float]:
    shares = [i / chunks for i in range(1, chunks)]
    found = values.agg(F.percentile_approx("v", doubles(shares), max(10_000, 4 * chunks)).alias("q")).first()
    return list(found["q"] or [])


def _tie_step(df: DataFrame, placed: DataFrame, tie: str, weight: dict[float, int], after: int) -> Column:
    """Within the bucket that starts at a heavy value: its own sub-chunks first, then (``after``) the rest.

    ``weight`` says how many chunks' worth of rows each heavy value holds; its sum is at most twice
    the number of chunks, and so is the number of cuts put into the plan.
    """
    number, value = order_number(df, tie), F.col("_v")
    most = max(weight.values())
    shares = [i / most for i in range(1, most)]
    at_heavy = placed.filter(value.isin(list(weight))).groupBy("_v")
    cells: list[Column] = []
    for row in at_heavy.agg(F.percentile_approx(number, doubles(shares), 10_000).alias("q")).collect():
        if not row["q"]:  # no tie values to cut by
            continue
        every = max(1, most // weight[row["_v"]])
        cells += [F.lit(row["_v"]), doubles(sorted(set(row["q"][every - 1 :: every])))]
    if not cells:
        return F.lit(0).cast("long")
    cuts = F.try_element_at(F.create_map(*cells), value)
    sub = F.size(F.filter(cuts, lambda cut: cut <= number))
    past = F.exists(doubles(sorted(weight)), lambda v: v < value)
    rest = F.when(past, F.lit(after)).otherwise(F.lit(0))
    return F.when(cuts.isNotNull(), sub).otherwise(rest).cast("long")
