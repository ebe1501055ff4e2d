"""Registration, table access and the stand-in inputs shared by the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.operators.sampling import BUCKETS
from loomstat.session import written

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows if there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(column: Column | str, digits: int = 6) -> Column:
    """Rounded, and never -0.0, so that a differing order of additions does not show."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)


# Ratings: who bought which part, and a rating from 1 to 5 taken from the quantity.
RATINGS_SQL = """
    SELECT o_custkey::INT AS user_id, l_partkey::INT AS product_id,
           1.0::DOUBLE + floor((l_quantity - 1) / 10) AS rating
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
"""


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The orders' lines as ratings, joined once and written to the shared folder for all later passes."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rated = joined.select(
        F.col("o_custkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("product"),
        (F.floor((F.col("l_quantity") - 1) / 10) + F.lit(1.0)).alias("rating"),
    )
    return written(rated, "ratings")


# Rows for regression and classification: three features, a price label and a class label.
ROWS_SQL = """
    SELECT l_quantity / 50 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2,
           l_extendedprice / 100000 AS price,
           CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag,
           l_orderkey
    FROM lineitem
"""
FEATURES = ["x0", "x1", "x2"]


def rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        (F.col("l_quantity") / 50).alias("x0"),
        (F.col("l_discount") * 10).alias("x1"),
        (F.col("l_tax") * 10).alias("x2"),
        (F.col("l_extendedprice") / 100000).alias("price"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("flag"),
        "l_orderkey",
    )


# The same 80 % of keys in SQL.
def in_train_sql(key: str) -> str:
    return f"(concat('0x', substr(md5({key}::VARCHAR), 1, 13))::BIGINT < {round(0.8 * BUCKETS)})"
