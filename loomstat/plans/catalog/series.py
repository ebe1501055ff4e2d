"""Series features, one point per row (events) and one series per row (embeddings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import series
from loomstat.operators.features import assemble
from loomstat.plans.catalog.base import query, rounded, table
from pyspark.ml.functions import vector_to_array

POINTS_SQL = """
    SELECT user_id AS series, value AS y,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS x, event_id
    FROM events
"""

ARRAY_POINTS_SQL = """
    SELECT vec_id AS series, unnest(embedding)::DOUBLE AS y,
           generate_subscripts(embedding, 1) - 1 AS x
    FROM embeddings
"""


def features_sql(points: str, key: str, digits: int | None = 6) -> str:
    """The definitions in SQL over points (series, x, y)."""

    def number(sql: str) -> str:
        return sql if digits is None else f"round({sql}, {digits}) + 0.0::DOUBLE"

    return f"""
    WITH s AS (
        SELECT series, x, y, avg(y) OVER (PARTITION BY series) AS m,
               stddev_pop(y) OVER (PARTITION BY series) AS sd
        FROM ({points})),
    z AS (SELECT *, (y - m) / CASE WHEN sd <= 0 THEN 1 ELSE sd END AS z FROM s),
    d AS (
        SELECT *, abs(z - coalesce(lag(z) OVER (PARTITION BY series ORDER BY x), 0)) AS step FROM z)
    SELECT series AS {key}, count(*) AS n, {number("avg(y)")} AS ybar,
           {number("stddev_pop(y)")} AS stdev, {number("regr_slope(y, x)")} AS slope,
           {number("max(step)")} AS largest_delta,
           count(*) FILTER (abs(z) > 1) AS one_sigma,
           count(*) FILTER (abs(z) > 2) AS two_sigma,
           count(*) FILTER (abs(z) > 3) AS three_sigma
    FROM d GROUP BY series
    """


def _tidy(df, key):
    floats = ["ybar", "stdev", "slope", "largest_delta"]
    return df.select(
        key, "n", *[rounded(c).alias(c) for c in floats], "one_sigma", "two_sigma", "three_sigma"
    )


@query("ts_features", features_sql(POINTS_SQL, "user_id"))
def ts_features(spark, folder):
    events = table(spark, folder, "events")
    return _tidy(series.series_features(events, "user_id", "ts", "event_id", "value"), "user_id")


@query(
    "ts_znorm",
    f"""WITH s AS (
            SELECT series, event_id, y, avg(y) OVER (PARTITION BY series) AS m,
                   stddev_pop(y) OVER (PARTITION BY series) AS sd
            FROM ({POINTS_SQL}))
        SELECT series AS user_id, event_id,
               round((y - m) / CASE WHEN sd <= 0 THEN 1 ELSE sd END, 6) + 0.0::DOUBLE AS z
        FROM s""",
)
def ts_znorm(spark, folder):
    scores = series.series_zscores(table(spark, folder, "events"), "user_id", "ts", "event_id", "value")
    return scores.select("user_id", "event_id", rounded("z").alias("z"))


@query("ts_features_wide", features_sql(ARRAY_POINTS_SQL, "vec_id"))
def ts_features_wide(spark, folder):
    featured = series.array_features(table(spark, folder, "embeddings"), "embedding", ["vec_id"])
    return _tidy(featured, "vec_id")


@query(
    "ts_feature_vector",
    f"""SELECT vec_id, ybar AS v0, stdev AS v1, slope AS v2, largest_delta AS v3,
               one_sigma::DOUBLE AS v4, two_sigma::DOUBLE AS v5, three_sigma::DOUBLE AS v6
        FROM ({features_sql(ARRAY_POINTS_SQL, "vec_id")})""",
)
def ts_feature_vector(spark, folder):
    featured = series.array_features(table(spark, folder, "embeddings"), "embedding", ["vec_id"])
    slots = vector_to_array("features")
    vectors = assemble(featured, series.FEATURES)
    return vectors.select(
        "vec_id", *[rounded(F.get(slots, i)).alias(f"v{i}") for i in range(len(series.FEATURES))]
    )
