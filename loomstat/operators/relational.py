"""Counts, shares, profiles and the pair join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions.text import longer_than, words


def word_count(df: DataFrame, text: str, longer: int = 3) -> DataFrame:
    """``word, n`` over whole texts, for words longer than ``longer``.

    The count is combined before the shuffle, so a word that makes up most of the text costs one
    row per task.
    """
    every = df.select(F.explode(words(text)).alias("word"))
    kept = every.filter(longer_than(F.col("word"), longer))
    return kept.groupBy("word").agg(F.count("*").alias("n"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def global_max_avg(df: DataFrame, max_of: str, avg_of: str) -> DataFrame:
    """One row: the largest ``max_of`` and the mean of ``avg_of``."""
    return df.agg(F.max(max_of).alias(f"max_{max_of}"), F.avg(avg_of).alias(f"avg_{avg_of}"))


def predicate_share(df: DataFrame, predicate: Column) -> DataFrame:
    """Share of rows for which the predicate holds, in one pass; unknown counts as not holding."""
    return df.agg(F.avg(F.when(predicate, 1.0).otherwise(0.0)).alias("share"))


def ratings_profile(ratings: DataFrame, user: str = "user", item: str = "product") -> DataFrame:
    """Rows, distinct users and distinct items in one pass."""
    return ratings.agg(
        F.count("*").alias("n_ratings"),
        F.count_distinct(F.col(user)).alias("n_users"),
        F.count_distinct(F.col(item)).alias("n_items"),
    )


def column_listing(df: DataFrame) -> DataFrame:
    """One row per column: position, name, and how many of its cells hold a value."""
    totals = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(c).alias("n_values"))
        for i, c in enumerate(df.columns, start=1)
    ]
    return totals.select(F.inline(F.array(*rows)))


def mean_per_pair(ratings: DataFrame, keys: Sequence[str], value: str = "rating") -> DataFrame:
    """One row per key with the mean value, as the factor models expect."""
    return ratings.groupBy(*keys).agg(F.avg(value).alias(value))


def join_pairs(
    predicted: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    prediction: str = "prediction",
    rating: str = "rating",
) -> DataFrame:
    """Inner join of predictions and ratings on a composite key, keeping both values.

    A key seen i times on one side and j times on the other stands for i*j joined rows. Both sides
    are counted per distinct value first and the product is returned as ``n_rows``, so a key with
    very many copies stays one row per distinct pair of values.
    """
    left = predicted.groupBy(*keys, prediction).agg(F.count("*").alias("_left"))
    right = actual.groupBy(*keys, rating).agg(F.count("*").alias("_right"))
    joined = left.join(right, list(keys), "inner")
    return joined.select(*keys, prediction, rating, (F.col("_left") * F.col("_right")).alias("n_rows"))
