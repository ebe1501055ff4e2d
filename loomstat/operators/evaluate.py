"""Metrics over a table that holds label and prediction side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomstat.functions import above, at_least
from loomstat.operators.ordering import CHUNK_ROWS, chunk_count, with_ordered_chunks
from loomstat.session import scratch_path


def _squared_error(prediction: str, label: str) -> Column:
    error = F.col(prediction) - F.col(label)
    return error * error


def mse(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.avg(_squared_error(prediction, label)).alias("mse"))


def rmse(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.sqrt(F.avg(_squared_error(prediction, label))).alias("rmse"))


def rmse_over_pairs(pairs: DataFrame, prediction: str = "prediction", rating: str = "rating") -> DataFrame:
    """Root mean squared error over the rows that ``join_pairs`` stands for."""
    n = F.col("n_rows")
    total = F.sum(_squared_error(prediction, rating) * n)
    return pairs.agg(F.sqrt(total / F.nullif(F.sum(n).cast("double"), F.lit(0.0))).alias("rmse"))


def accuracy(df: DataFrame, predicted: Column, label: str = "label") -> DataFrame:
    """Share of rows whose predicted class equals the label, in one pass."""
    return df.agg(F.avg(F.when(predicted == F.col(label), 1.0).otherwise(0.0)).alias("accuracy"))


def margin_class(score: str = "prediction") -> Column:
    return above(F.col(score), 0.0)


def cut_class(score: str = "prediction", cut: float = 0.5) -> Column:
    return at_least(F.col(score), cut)


def threshold_curve(
    df: DataFrame, score: str = "prediction", label: str = "label", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """One row per distinct score, falling: its positives and negatives and those down to it.

    Rows without a score or a label are left out. Scores are worked out once and written to the shared
    folder with their labels; counting, cutting and adding up read that narrow table.

    Rows are counted per score before the shuffle. Continuous scores leave as many rows as the
    input; beyond one chunk of them the running sums are taken within ordered chunks of the score
    and shifted by the totals of the chunks above, one row per chunk.
    """
    rows = df.select(
        (-F.col(score).cast("double")).alias("down"), (F.col(label) > 0.5).cast("long").alias("hit")
    ).dropna()
    path = scratch_path(df.sparkSession, "scores")
    rows.write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    chunks = chunk_count(rows, chunk_rows)
    hits, misses = F.sum("hit"), F.sum(1 - F.col("hit"))
    if chunks == 1:
        points = rows.groupBy("down").agg(hits.alias("pos"), misses.alias("neg"))
        falling, every = Window.orderBy("down").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
        tp, fp = F.sum("pos").over(falling), F.sum("neg").over(falling)
        totals = F.sum("pos").over(every), F.sum("neg").over(every)
    else:
        placed = with_ordered_chunks(rows, "down", None, chunks)
        points = _chunked_points(placed.groupBy("chunk", "down").agg(hits.alias("pos"), misses.alias("neg")))
        tp, fp = F.col("_tp") + F.col("_tp_above"), F.col("_fp") + F.col("_fp_above")
        totals = F.col("_n_pos"), F.col("_n_neg")
    return points.select(
        (-F.col("down")).alias("score"),
        "pos",
        "neg",
        tp.alias("tp"),
        fp.alias("fp"),
        totals[0].alias("n_pos"),
        totals[1].alias("n_neg"),
    )


def _chunked_points(points: DataFrame) -> DataFrame:
    """Running sums within each chunk, next to the sums of the chunks above and of all chunks."""
    totals = points.groupBy("chunk").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    # one row per chunk, so neither these windows nor the broadcast grows with the table
    above_it, every = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    shifts = totals.select(
        "chunk",
        F.coalesce(F.sum("_p").over(above_it), F.lit(0)).alias("_tp_above"),
        F.coalesce(F.sum("_n").over(above_it), F.lit(0)).alias("_fp_above"),
        F.sum("_p").over(every).alias("_n_pos"),
        F.sum("_n").over(every).alias("_n_neg"),
    )
    running = Window.partitionBy("chunk").orderBy("down").rowsBetween(Window.unboundedPreceding, 0)
    summed = points.withColumn("_tp", F.sum("pos").over(running)).withColumn("_fp", F.sum("neg").over(running))
    return summed.join(F.broadcast(shifts), "chunk")


def _roc_area() -> Column:
    tp, pos, neg = F.col("tp"), F.col("pos"), F.col("neg")
    area = F.sum(neg.cast("double") * (tp - pos / F.lit(2.0)))
    pairs = F.first("n_pos").cast("double") * F.first("n_neg")
    return area / F.nullif(pairs, F.lit(0.0))


def _pr_area() -> Column:
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    here = tp / (tp + fp).cast("double")
    seen = F.nullif((tp + fp - pos - neg).cast("double"), F.lit(0.0))
    prior = F.coalesce((tp - pos) / seen, here)
    area = F.sum(pos * (here + prior) / F.lit(2.0))
    return area / F.nullif(F.first("n_pos").cast("double"), F.lit(0.0))


def area_under_roc(curve: DataFrame) -> DataFrame:
    """Trapezoids from (0, 0) to (1, 1); NULL when one class is missing."""
    return curve.agg(_roc_area().alias("auc_roc"))


def area_under_pr(curve: DataFrame) -> DataFrame:
    """Trapezoids over recall; the curve starts at recall 0 with the top score's precision."""
    return curve.agg(_pr_area().alias("auc_pr"))


def binary_areas(df: DataFrame, score: str = "prediction", label: str = "label") -> DataFrame:
    """Both areas from one curve."""
    curve = threshold_curve(df, score, label)
    return curve.agg(_roc_area().alias("auc_roc"), _pr_area().alias("auc_pr"))


# Doubles lie between 2**-1074 and 2**1024: with m bits a summary has at most 2 * 2100 * 2**m bins.
LOWEST = 1075
SUMMARY_BITS = 10


def score_bin(score: Column, bits: int = SUMMARY_BITS) -> Column:
    """A bin number that never falls where the score rises; each doubling of the score has 2**bits bins.

    For a positive score x = 2**e * f with f in [1, 2) it is the whole part of (e + f - 1) * 2**bits, counted
    from the least double on; the expression is the same for f = 2 and the next e, so it does not
    matter how the logarithm of a power of two is rounded. Zero is bin 0, negative scores mirror.
    """
    size = F.abs(score)
    e = F.floor(F.log2(size)).cast("double")
    steps = F.floor((e + F.lit(float(LOWEST)) + size / F.pow(F.lit(2.0), e) - 1.0) * float(1 << bits)) + 1
    far = F.lit((2 * LOWEST) << bits).cast("long")
    steps = F.when(size == float("inf"), far).otherwise(steps.cast("long"))
    return F.when(score > 0, steps).when(score < 0, -steps).otherwise(F.lit(0).cast("long"))


def score_summary(df: DataFrame, score: str = "prediction", label: str = "label", bits: int = SUMMARY_BITS) -> DataFrame:
    """``bin, pos, neg``: how many positives and negatives have a score in each bin; one pass.

    Counts are combined before the shuffle, and summaries of parts of a table merge by adding them up.
    The size is bounded by ``bits`` alone, whatever the rows. Rows without a score or a label are left out.
    """
    rows = df.select(F.col(score).cast("double").alias("s"), (F.col(label) > 0.5).cast("long").alias("hit")).dropna()
    return rows.groupBy(score_bin(F.col("s"), bits).alias("bin")).agg(
        F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg")
    )


def summary_areas(summary: DataFrame) -> DataFrame:
    """``auc_roc, roc_error, auc_pr, pr_error`` from a summary: the exact areas lie within the errors.

    Only the order within a bin is unknown. For the ROC area its p positives and n negatives can make at
    most p * n / 2 pairs of difference either way. For the PR area the precision seen by each of its
    positives lies between the one with all of the bin's negatives and none of its positives before it,
    and the one with all of its positives and none of its negatives; the estimate is the middle.
    A missing class gives null, as with the exact curve.
    """
    down = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)  # a bounded number of bins
    every = Window.partitionBy()
    cells = summary.select(
        F.col("pos").cast("double").alias("p"),
        F.col("neg").cast("double").alias("n"),
        F.coalesce(F.sum("pos").over(down), F.lit(0)).cast("double").alias("tp"),
        F.coalesce(F.sum("neg").over(down), F.lit(0)).cast("double").alias("fp"),
        F.sum("pos").over(every).cast("double").alias("all_p"),
        F.sum("neg").over(every).cast("double").alias("all_n"),
    )
    p, n, tp, fp = (F.col(c) for c in ("p", "n", "tp", "fp"))
    pairs = F.nullif(F.first("all_p") * F.first("all_n"), F.lit(0.0))
    low = F.coalesce(tp / F.nullif(tp + fp + n, F.lit(0.0)), F.lit(0.0))
    high = F.coalesce((tp + p) / F.nullif(tp + p + fp, F.lit(0.0)), F.lit(0.0))
    hits = F.nullif(F.first("all_p"), F.lit(0.0))
    return cells.agg(
        (F.sum(n * (tp + p / 2)) / pairs).alias("auc_roc"),
        (F.sum(n * p / 2) / pairs).alias("roc_error"),
        (F.sum(p * (low + high) / 2) / hits).alias("auc_pr"),
        (F.sum(p * (high - low) / 2) / hits).alias("pr_error"),
    )
