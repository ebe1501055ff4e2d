"""Alternating least squares from starts that SQL can repeat: two factors, each half-step in closed form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomstat.operators import factorize, recommend
from loomstat.operators.sampling import split_by_key
from loomstat.plans.catalog import oracle
from loomstat.plans.catalog.base import RATINGS_SQL, in_train_sql, query, ratings, rounded

RANK, REG = 2, 0.1
PAIRS_SQL = f"SELECT user_id AS u, product_id AS p, avg(rating) AS r FROM ({RATINGS_SQL}) GROUP BY ALL"
# Confidences on both sides of zero, as the shift of ratings gives them.
SHIFTED_SQL = f"SELECT u, p, r - 2.5 AS r FROM ({PAIRS_SQL})"
TRAIN = in_train_sql("concat(user_id, ':', product_id)")
TRAIN_SQL = f"SELECT user_id AS u, product_id AS p, avg(rating) AS r FROM ({RATINGS_SQL}) WHERE {TRAIN} GROUP BY ALL"
FACTORS_SQL = "round(f0, 6) + 0.0::DOUBLE AS f0, round(f1, 6) + 0.0::DOUBLE AS f1"


def _shifted(data: DataFrame) -> DataFrame:
    return data.withColumn("rating", F.col("rating") - 2.5)


def _factors(table: DataFrame) -> DataFrame:
    return table.select("id", *[rounded(F.get("features", i)).alias(f"f{i}") for i in range(RANK)])


@query("als_half_step", f"{oracle.als_sql(PAIRS_SQL, 1, REG)} SELECT id, {FACTORS_SQL} FROM items1")
def als_half_step(spark, folder):
    """Product factors from the users' start."""
    pairs = factorize.mean_per_pair(ratings(spark, folder), ["user", "product"])
    users = factorize.start_factors(pairs.select(F.col("user").alias("id")).distinct(), RANK, 0)
    return _factors(factorize.half_step(pairs, users, RANK, REG, by="product", other="user"))


@query(
    "als_half_step_implicit",
    f"{oracle.als_sql(SHIFTED_SQL, 1, REG, implicit=True)} SELECT id, {FACTORS_SQL} FROM items1",
)
def als_half_step_implicit(spark, folder):
    """Product factors from the users' start: shared Gram matrix, corrections for the observed pairs."""
    pairs = _shifted(factorize.mean_per_pair(ratings(spark, folder), ["user", "product"]))
    users = factorize.start_factors(pairs.select(F.col("user").alias("id")).distinct(), RANK, 0)
    return _factors(factorize.half_step(pairs, users, RANK, REG, True, by="product", other="user"))


@query("als_user_factors", f"{oracle.als_sql(SHIFTED_SQL, 4, REG, implicit=True)} SELECT id, {FACTORS_SQL} FROM users2")
def als_user_factors(spark, folder):
    """User factors after two implicit iterations."""
    pairs = _shifted(factorize.mean_per_pair(ratings(spark, folder), ["user", "product"]))
    return _factors(factorize.factorize(pairs, RANK, 2, REG, implicit=True).userFactors)


def _trained(spark, folder):
    data = ratings(spark, folder).withColumn("pair", F.concat_ws(":", "user", "product"))
    training, test = split_by_key(data, "pair")
    return factorize.factorize(training, RANK, 2, REG), test


@query(
    "als_scores",
    f"""{oracle.als_sql(TRAIN_SQL, 4, REG)}
        SELECT t.u AS user, t.p AS product, round(a.f0 * b.f0 + a.f1 * b.f1, 6) + 0.0::DOUBLE AS prediction
        FROM (SELECT DISTINCT user_id AS u, product_id AS p FROM ({RATINGS_SQL}) WHERE NOT {TRAIN}) t
        JOIN users2 a ON a.id = t.u JOIN items2 b ON b.id = t.p""",
)
def als_scores(spark, folder):
    """Every held-out pair that the model knows, with its prediction."""
    model, test = _trained(spark, folder)
    scored = recommend.score_pairs(model, test.select("user", "product").distinct())
    return scored.select("user", "product", rounded("prediction").alias("prediction"))


@query(
    "als_rmse",
    f"""{oracle.als_sql(TRAIN_SQL, 4, REG)},
        t AS (SELECT user_id AS u, product_id AS p, rating AS r FROM ({RATINGS_SQL}) WHERE NOT {TRAIN})
        SELECT round(sqrt(avg((x.s - t.r) ** 2)), 6) + 0.0::DOUBLE AS rmse
        FROM t JOIN (SELECT t.u, t.p, a.f0 * b.f0 + a.f1 * b.f1 AS s
                     FROM t JOIN users2 a ON a.id = t.u JOIN items2 b ON b.id = t.p) x USING (u, p)""",
)
def als_rmse(spark, folder):
    """Error on the held-out pairs; a pair rated k times weighs k * k, as joining scores to ratings has it."""
    model, test = _trained(spark, folder)
    return recommend.recommender_rmse(model, test).select(rounded("rmse").alias("rmse"))


@query(
    "als_top10",
    f"""{oracle.als_sql(TRAIN_SQL, 4, REG)},
        s AS (SELECT b.id AS product, a.f0 * b.f0 + a.f1 * b.f1 AS s
              FROM (SELECT * FROM users2 ORDER BY id LIMIT 1) a, items2 b)
        SELECT row_number() OVER (ORDER BY s DESC, product) AS place, product, round(s, 6) + 0.0::DOUBLE AS rating
        FROM s ORDER BY s DESC, product LIMIT 10""",
)
def als_top10(spark, folder):
    """The ten best products of the first user, with their ratings."""
    model, _ = _trained(spark, folder)
    user = model.userFactors.agg(F.min("id")).first()[0]
    order = Window.orderBy(F.col("rating").desc(), "product")  # ten rows
    top = recommend.top_items(model, user, 10)
    return top.select(F.row_number().over(order).cast("long").alias("place"), "product", rounded("rating").alias("rating"))
