"""Scoring with given models and every metric, on scores computed from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.functions import above, clip_unit
from loomstat.operators import clustering, evaluate
from loomstat.operators.descent import dot
from loomstat.operators.features import assemble
from loomstat.operators.relational import join_pairs
from loomstat.plans.catalog.base import (
    FEATURES,
    ROWS_SQL,
    query,
    rounded,
    rows,
    table,
)
from loomstat.plans.catalog.tables import SCORED_SQL, scored_ratings
from pyspark.ml.functions import vector_to_array

WEIGHTS = [0.5, -0.25, 0.125]
MARGIN_SQL = "(x0 * 0.5::DOUBLE + x1 * -0.25::DOUBLE + x2 * 0.125::DOUBLE)"


def _margin():
    return dot([F.col(f) for f in FEATURES], WEIGHTS)


@query(
    "assemble_features",
    "SELECT l_quantity AS f0, l_discount AS f1, l_tax AS f2, l_orderkey, l_linenumber FROM lineitem",
)
def assemble_features(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"
    )
    vectors = assemble(lines, ["l_quantity", "l_discount", "l_tax"])
    slots = vector_to_array("features")
    return vectors.select(
        "l_orderkey", "l_linenumber", *[F.get(slots, i).alias(f"f{i}") for i in range(3)]
    )


@query("score_linear", f"SELECT l_orderkey, round({MARGIN_SQL}, 6) + 0.0::DOUBLE AS prediction FROM ({ROWS_SQL})")
def score_linear(spark, folder):
    return rows(spark, folder).select("l_orderkey", rounded(_margin()).alias("prediction"))


@query(
    "score_margin",
    f"""SELECT l_orderkey, round({MARGIN_SQL} - 0.2, 6) + 0.0::DOUBLE AS margin,
               CASE WHEN {MARGIN_SQL} - 0.2::DOUBLE > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS predicted
        FROM ({ROWS_SQL})""",
)
def score_margin(spark, folder):
    margin = _margin() - F.lit(0.2)
    return rows(spark, folder).select(
        "l_orderkey", rounded(margin).alias("margin"), above(margin).alias("predicted")
    )


@query(
    "score_probability",
    f"SELECT l_orderkey, round(1 / (1 + exp(-{MARGIN_SQL})), 6) AS probability FROM ({ROWS_SQL})",
)
def score_probability(spark, folder):
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin()))
    return rows(spark, folder).select("l_orderkey", rounded(probability).alias("probability"))


def _scored(spark, folder):
    return rows(spark, folder).select(
        F.col("price").alias("label"), "flag", _margin().alias("prediction")
    )


@query("eval_rmse", f"SELECT round(sqrt(avg(({MARGIN_SQL} - price) ** 2)), 6) AS rmse FROM ({ROWS_SQL})")
def eval_rmse(spark, folder):
    return evaluate.rmse(_scored(spark, folder)).select(rounded("rmse").alias("rmse"))


@query("eval_mse", f"SELECT round(avg(({MARGIN_SQL} - price) ** 2), 6) AS mse FROM ({ROWS_SQL})")
def eval_mse(spark, folder):
    return evaluate.mse(_scored(spark, folder)).select(rounded("mse").alias("mse"))


@query(
    "eval_accuracy",
    f"""SELECT round(avg(CASE WHEN (CASE WHEN {MARGIN_SQL} > 0 THEN 1 ELSE 0 END) = flag
                              THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS margin_accuracy,
               round(avg(CASE WHEN (CASE WHEN x0 < 0.5 THEN 0 ELSE 1 END) = flag
                              THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS cut_accuracy
        FROM ({ROWS_SQL})""",
)
def eval_accuracy(spark, folder):
    scored = rows(spark, folder).select("flag", "x0", _margin().alias("prediction"))
    shares = {"margin_accuracy": evaluate.margin_class(), "cut_accuracy": evaluate.cut_class("x0")}
    hit = {n: F.when(c == F.col("flag"), 1.0).otherwise(0.0) for n, c in shares.items()}
    return scored.agg(*[rounded(F.avg(h)).alias(n) for n, h in hit.items()])


CURVE_SQL = f"""
    WITH p AS (
        SELECT price AS score, count(*) FILTER (flag = 1) AS pos, count(*) FILTER (flag = 0) AS neg
        FROM ({ROWS_SQL}) GROUP BY price),
    c AS (
        SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
               sum(pos) OVER () AS np, sum(neg) OVER () AS nn
        FROM p WINDOW w AS (ORDER BY score DESC)),
    r AS (
        SELECT tp / np AS recall, fp / nn AS fall_out, tp / (tp + fp) AS precision_here,
               row_number() OVER (ORDER BY score DESC) AS k FROM c),
    s AS (
        SELECT recall, fall_out, precision_here,
               coalesce(lag(recall) OVER (ORDER BY k), 0) AS recall0,
               coalesce(lag(fall_out) OVER (ORDER BY k), 0) AS fall_out0,
               coalesce(lag(precision_here) OVER (ORDER BY k), precision_here) AS precision0
        FROM r)
"""


def _priced(spark, folder):
    return rows(spark, folder).select(F.col("price").alias("prediction"), F.col("flag").alias("label"))


@query(
    "eval_auc_roc",
    f"{CURVE_SQL} SELECT round(sum((fall_out - fall_out0) * (recall + recall0) / 2), 6) AS auc_roc FROM s",
)
def eval_auc_roc(spark, folder):
    area = evaluate.area_under_roc(evaluate.threshold_curve(_priced(spark, folder)))
    return area.select(rounded("auc_roc").alias("auc_roc"))


@query(
    "eval_auc_pr",
    f"""{CURVE_SQL}
    SELECT round(sum((recall - recall0) * (precision_here + precision0) / 2), 6) AS auc_pr FROM s""",
)
def eval_auc_pr(spark, folder):
    area = evaluate.area_under_pr(evaluate.threshold_curve(_priced(spark, folder)))
    return area.select(rounded("auc_pr").alias("auc_pr"))


_BIN = "floor((e + 1075 + s / 2.0::DOUBLE ** e - 1) * 1024) + 1"
SUMMARY_SQL = f"""
    WITH b AS (SELECT CASE WHEN s > 0 THEN {_BIN} ELSE 0 END AS bin, y FROM (
             SELECT *, floor(log2(nullif(abs(s), 0))) AS e FROM ({{rows}}))),
    c AS (SELECT bin, sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS n FROM b GROUP BY bin),
    d AS (SELECT *, coalesce(sum(p) OVER w, 0) AS tp, coalesce(sum(n) OVER w, 0) AS fp,
                 sum(p) OVER () AS all_p, sum(n) OVER () AS all_n
          FROM c WINDOW w AS (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    r AS (SELECT *, coalesce(tp / nullif(tp + fp + n, 0), 0) AS low, coalesce((tp + p) / nullif(tp + p + fp, 0), 0) AS high FROM d)
"""


@query(
    "eval_areas_summary",
    SUMMARY_SQL.format(rows="SELECT l_extendedprice AS s, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem")
    + """SELECT round(sum(n * (tp + p / 2)) / first(all_p * all_n), 6) AS auc_roc,
                round(sum(n * p / 2) / first(all_p * all_n), 6) AS roc_error,
                round(sum(p * (low + high) / 2) / first(all_p), 6) AS auc_pr,
                round(sum(p * (high - low) / 2) / first(all_p), 6) AS pr_error FROM r""",
)
def eval_areas_summary(spark, folder):
    """Both areas of the price as a score for returns, from a summary of bounded size, with their errors."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("prediction"), F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label")
    )
    found = evaluate.summary_areas(evaluate.score_summary(lines))
    return found.select(*[rounded(c).alias(c) for c in found.columns])


@query(
    "eval_threshold_curve",
    f"SELECT score, pos, neg, tp::BIGINT AS tp, fp::BIGINT AS fp FROM (SELECT * FROM ({CURVE_SQL} SELECT * FROM c))",
)
def eval_threshold_curve(spark, folder):
    curve = evaluate.threshold_curve(_priced(spark, folder))
    return curve.select("score", "pos", "neg", "tp", "fp")


@query(
    "eval_rmse_pairs",
    f"""{SCORED_SQL}
    SELECT round(sqrt(avg((prediction - rating) ** 2)), 6) AS rmse
    FROM predicted p JOIN actual a ON p.user_id = a.user_id AND p.product_id = a.product_id""",
)
def eval_rmse_pairs(spark, folder):
    predicted, actual = scored_ratings(spark, folder)
    pairs = join_pairs(predicted, actual, ["user", "product"])
    return evaluate.rmse_over_pairs(pairs).select(rounded("rmse").alias("rmse"))


@query(
    "eval_rmse_implicit",
    f"""{SCORED_SQL}
    SELECT round(sqrt(avg((greatest(least(prediction - 2, 1), 0)
                           - CASE WHEN rating - 2.5 > 0 THEN 1 ELSE 0 END) ** 2)), 6) AS rmse
    FROM predicted p JOIN actual a ON p.user_id = a.user_id AND p.product_id = a.product_id""",
)
def eval_rmse_implicit(spark, folder):
    predicted, actual = scored_ratings(spark, folder)
    clipped = predicted.withColumn("prediction", clip_unit(F.col("prediction") - 2))
    binary = actual.withColumn("rating", above(F.col("rating") - 2.5))
    pairs = join_pairs(clipped, binary, ["user", "product"])
    return evaluate.rmse_over_pairs(pairs).select(rounded("rmse").alias("rmse"))


CENTERS = [(0.1, 0.1), (0.5, 0.5), (0.9, 0.9)]
DISTANCES_SQL = ", ".join(
    f"(x0 - {a}::DOUBLE) * (x0 - {a}::DOUBLE) + (x1 - {b}::DOUBLE) * (x1 - {b}::DOUBLE) AS d{i}"
    for i, (a, b) in enumerate(CENTERS)
)


@query(
    "kmeans_assign",
    f"""SELECT x0, x1, n, CASE WHEN d0 <= least(d0, d1, d2) * (1 + 1e-9) THEN 0
                              WHEN d1 <= least(d0, d1, d2) * (1 + 1e-9) THEN 1 ELSE 2 END AS cluster
        FROM (SELECT x0, x1, n, {DISTANCES_SQL}
              FROM (SELECT x0, x1, count(*) AS n FROM ({ROWS_SQL}) GROUP BY x0, x1))""",
)
def kmeans_assign(spark, folder):
    assigned = clustering.assign(rows(spark, folder).select("x0", "x1"), ["x0", "x1"], CENTERS)
    return assigned.groupBy("x0", "x1", "cluster").agg(F.count("*").alias("n"))


@query(
    "kmeans_assign_wide",
    """WITH c AS (SELECT list(v ORDER BY vec_id) AS cs FROM (
           SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 25 = 0 ORDER BY vec_id LIMIT 20)),
       d AS (SELECT vec_id, list_transform(cs, lambda c: list_sum(list_transform(
                 list_zip(embedding::DOUBLE[], c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS ds
             FROM embeddings, c)
       SELECT vec_id, list_position(list_transform(ds, lambda d: d <= list_min(ds) * (1 + 1e-9)), true)::INT - 1 AS cluster
       FROM d""",
)
def kmeans_assign_wide(spark, folder):
    """Every embedding assigned to the nearest of twenty given ones."""
    vectors = table(spark, folder, "embeddings")
    points = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    given = points.filter(F.col("vec_id") % 25 == 0).orderBy("vec_id").limit(20).collect()
    return clustering.assign(points, "v", [r["v"] for r in given]).select("vec_id", "cluster")


@query(
    "kmeans_cost",
    f"""SELECT round(sum(least(d0, d1, d2)), 6) AS cost
        FROM (SELECT {DISTANCES_SQL} FROM ({ROWS_SQL}))""",
)
def kmeans_cost(spark, folder):
    total = clustering.cost(rows(spark, folder), ["x0", "x1"], CENTERS)
    return total.select(rounded("cost").alias("cost"))
