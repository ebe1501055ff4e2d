"""Seven features per numeric series, for series stored one point or one series per row.

Definitions, for points y[0..n-1] and x = 0..n-1:

* ``ybar`` the mean, ``stdev`` the population deviation
* z = y - ybar, divided by ``stdev`` where that is above zero
* ``slope`` the least-squares slope of y over x (NULL for a single point)
* ``largest_delta`` the largest step between neighbouring z, counting a step from 0 to the first
* ``one_sigma``, ``two_sigma``, ``three_sigma`` how many z lie beyond 1, 2, 3 in absolute value
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomstat.operators.ordering import CHUNK_ROWS, order_number, with_ordered_chunks

FEATURES = ["ybar", "stdev", "slope", "largest_delta", "one_sigma", "two_sigma", "three_sigma"]


def _z(value: Column, mean: Column, stdev: Column) -> Column:
    return (value - mean) / F.when(stdev <= 0, F.lit(1.0)).otherwise(stdev)


def _chunked_stats(rows: DataFrame, series: str) -> DataFrame:
    """Per (series, chunk): the whole series' size, mean and deviation, and the points before.

    Points are reduced per (series, chunk) before any shuffle; the windows see one row per chunk.
    """
    parts = rows.groupBy(series, "chunk").agg(
        F.count("_y").alias("_n"), F.avg("_y").alias("_m"), F.var_pop("_y").alias("_v")
    )
    whole = Window.partitionBy(series)
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    n, m = F.col("_n"), F.col("_m")
    parts = parts.withColumn("n", F.sum(n).over(whole))
    parts = parts.withColumn("ybar", F.sum(n * m).over(whole) / F.col("n"))
    spread = F.sum(n * (F.col("_v") + (m - F.col("ybar")) * (m - F.col("ybar")))).over(whole)
    return parts.select(
        series,
        "chunk",
        "n",
        "ybar",
        F.sqrt(spread / F.col("n")).alias("stdev"),
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias("_before"),
    )


def _points(
    df: DataFrame, series: str, order: str, tie: str, value: str, chunk_rows: int
) -> DataFrame:
    """The points that have a series and a value, with a chunk number for those of long series.

    Only a series of more than ``chunk_rows`` points is cut; there are few of them, and their keys
    and the cuts are fetched. All others are chunk 0, and need one shuffle by series.
    """
    rows = df.select(*dict.fromkeys([series, order, tie]), F.col(value).cast("double").alias("_y"))
    rows = rows.filter(F.col(series).isNotNull() & F.col("_y").isNotNull())
    order_number(rows, order)  # the same types are refused at every size
    counts = rows.groupBy(series).agg(F.count("*").alias("_n")).filter(F.col("_n") > chunk_rows).collect()
    if not counts:
        return rows.withColumn("chunk", F.lit(0).cast("long"))
    long = F.col(series).isin([r[0] for r in counts])
    parts = math.ceil(sum(r["_n"] for r in counts) / chunk_rows)
    cut = with_ordered_chunks(rows.filter(long), order, tie, parts)
    return rows.filter(~long).withColumn("chunk", F.lit(0).cast("long")).unionByName(cut)


def series_zscores(
    df: DataFrame, series: str, order: str, tie: str, value: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Every point with a series and a value, and its z-value: ``series, order, tie, z``."""
    rows = _points(df, series, order, tie, value, chunk_rows)
    stats = _chunked_stats(rows, series)
    joined = rows.join(stats, [series, "chunk"])
    return joined.select(series, order, tie, _z(F.col("_y"), F.col("ybar"), F.col("stdev")).alias("z"))


def series_features(
    df: DataFrame, series: str, order: str, tie: str, value: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The seven features and ``n`` per series, from one row per point; points without a value are
    left out before they are numbered.

    Join, window and first aggregate all work per (series, chunk) on one shuffle of the points, so
    a series with a third of all points is spread like any other. The second shuffle carries one
    row per (series, chunk).
    """
    rows = _points(df, series, order, tie, value, chunk_rows)
    joined = rows.join(_chunked_stats(rows, series), [series, "chunk"])
    local = Window.partitionBy(series, "chunk").orderBy(order, tie)
    z = _z(F.col("_y"), F.col("ybar"), F.col("stdev"))
    ranked = joined.select(
        series, "chunk", "n", "ybar", "stdev", "_before", "_y",
        z.alias("_z"),
        F.row_number().over(local).alias("_i"),
        F.lag(z).over(local).alias("_prev"),
    )
    x = F.col("_before") + F.col("_i") - 1
    from_middle = x - (F.col("n") - 1) / F.lit(2.0)
    size = F.abs(F.col("_z"))
    parts = ranked.groupBy(series, "chunk").agg(
        F.first("n").alias("n"),
        F.first("ybar").alias("ybar"),
        F.first("stdev").alias("stdev"),
        F.sum(from_middle * (F.col("_y") - F.col("ybar"))).alias("_xy"),
        F.max(F.abs(F.col("_z") - F.col("_prev"))).alias("_step"),
        F.min_by("_z", "_i").alias("_first"),
        F.max_by("_z", "_i").alias("_last"),
        F.count_if(size > 1).alias("_1"),
        F.count_if(size > 2).alias("_2"),
        F.count_if(size > 3).alias("_3"),
    )
    left = F.lag("_last").over(Window.partitionBy(series).orderBy("chunk"))
    parts = parts.withColumn("_edge", F.abs(F.col("_first") - F.coalesce(left, F.lit(0.0))))
    n = F.first("n").cast("double")
    return parts.groupBy(series).agg(
        F.first("n").alias("n"),
        F.first("ybar").alias("ybar"),
        F.first("stdev").alias("stdev"),
        (F.sum("_xy") / F.nullif(n * (n * n - 1) / 12, F.lit(0.0))).alias("slope"),
        F.max(F.greatest("_edge", "_step")).alias("largest_delta"),
        F.sum("_1").alias("one_sigma"),
        F.sum("_2").alias("two_sigma"),
        F.sum("_3").alias("three_sigma"),
    )


def _spread(y: Column) -> Column:
    """One fold over the points: how many, their mean, the sum of squares about it, and the sum of
    products with the positions about theirs; each point corrects the running mean, so a constant
    series has a spread of exactly zero."""
    none = F.struct(*[F.lit(0.0).alias(f) for f in ("n", "mean", "squares", "products")])

    def add(s: Column, v: Column) -> Column:
        n = s["n"] + 1.0
        off = v - s["mean"]
        # the mean position of the points so far is (n - 2) / 2, the new point stands at n - 1
        return F.struct(
            n.alias("n"),
            (s["mean"] + off / n).alias("mean"),
            (s["squares"] + off * (off - off / n)).alias("squares"),
            (s["products"] + off * (n / 2.0) * (n - 1.0) / n).alias("products"),
        )

    def finish(s: Column) -> Column:
        n = F.nullif(s["n"], F.lit(0.0))
        return F.struct(
            F.when(s["n"] > 0, s["mean"]).alias("mean"),
            F.sqrt(s["squares"] / n).alias("stdev"),
            (s["products"] / F.nullif(n * (n * n - 1) / 12, F.lit(0.0))).alias("slope"),
        )

    return F.aggregate(y, none, add, finish)


def _steps(y: Column, spread: Column) -> Column:
    """A second fold: the largest step between neighbouring z, and how many lie beyond 1, 2, 3.

    Mean and deviation ride in the accumulator, so they are worked out once per series and not once
    per point, wherever the optimizer moves the expression.
    """
    none = F.struct(
        spread.alias("s"),
        F.lit(0.0).alias("last"),
        F.lit(None).cast("double").alias("step"),
        *[F.lit(0).cast("long").alias(f"over{k}") for k in (1, 2, 3)],
    )

    def add(a: Column, v: Column) -> Column:
        z = _z(v, a["s"]["mean"], a["s"]["stdev"])
        beyond = [(a[f"over{k}"] + F.when(F.abs(z) > k, 1).otherwise(0)).alias(f"over{k}") for k in (1, 2, 3)]
        step = F.greatest(a["step"], F.abs(z - a["last"]))
        return F.struct(a["s"].alias("s"), z.alias("last"), step.alias("step"), *beyond)

    return F.aggregate(y, none, add)


def array_features(df: DataFrame, points: str, keep: list[str]) -> DataFrame:
    """The seven features of each row's array; no shuffle, every row stands alone.

    Two folds give one struct, and each feature is a field of it: whatever is asked of the features
    later (a filter that is pushed below them, for one) costs folds in proportion, not their product.
    """
    y = F.transform(F.col(points), lambda v: v.cast("double"))
    found = df.select(*keep, F.size(points).cast("long").alias("n"), _steps(y, _spread(y)).alias("_f"))
    names = {"largest_delta": "step", "one_sigma": "over1", "two_sigma": "over2", "three_sigma": "over3"}
    return found.select(
        *keep,
        "n",
        *[F.col(f"_f.s.{f}").alias({"mean": "ybar"}.get(f, f)) for f in ("mean", "stdev", "slope")],
        *[F.col(f"_f.{f}").alias(name) for name, f in names.items()],
    )
