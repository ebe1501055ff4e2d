"""Joining rows to a table with one row per key when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is dealt to several tasks, each with about so many of them.
TASK_ROWS = 1_000_000
# Tables up to this size are sent to every executor instead.
BROADCAST_BYTES = 64 << 20


def hot_keys(rows: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """``key, _salts``: keys of more than ``task_rows`` rows, and how many tasks their rows need.

    One grouped count, combined before the shuffle. There is at most one such key per ``task_rows``
    rows of the table, a small fraction of a small table.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    return counts.filter(F.col("_n") > task_rows).select(key, F.ceil(F.col("_n") / task_rows).cast("int").alias("_salts"))


def join_lookup(
    rows: DataFrame, table: DataFrame, key: str, spread_by: Column, row_bytes: int, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Inner join to a table that holds each key once.

    The table is counted: a small one is broadcast. Otherwise the rows of a hot key are dealt by
    ``spread_by`` to as many tasks as they fill, and only the hot keys' table rows are repeated for it.
    """
    if table.count() * row_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), key)
    found = hot_keys(rows, key, task_rows).collect()
    if not found:
        return rows.join(table, key)
    hot = rows.sparkSession.createDataFrame(found, hot_keys(rows, key, task_rows).schema)
    hot = F.broadcast(hot) if len(found) * 64 <= BROADCAST_BYTES else hot
    salts = F.coalesce("_salts", F.lit(1))
    salted = rows.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), salts).cast("int"))
    every = F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")
    repeated = table.join(hot, key, "left").select(*table.columns, every)
    return salted.drop("_salts").join(repeated, [key, "_salt"]).drop("_salt")
