import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loomstat.operators import evaluate
from loomstat.session import scratch_path


def scored(spark, cells):
    return spark.createDataFrame(cells, "prediction double, label double")


def library(df, metric):
    return BinaryClassificationEvaluator(rawPredictionCol="prediction", metricName=metric, numBins=0).evaluate(df)


@pytest.mark.parametrize("chunk_rows", [2_000_000, 40])
@pytest.mark.parametrize("digits", [1, 9])
def test_areas_equal_the_library(spark, chunk_rows, digits):
    df = spark.range(1000).select(
        F.round(F.rand(3), digits).alias("prediction"), (F.rand(5) < 0.3).cast("double").alias("label")
    ).cache()
    curve = evaluate.threshold_curve(df, chunk_rows=chunk_rows)
    assert evaluate.area_under_roc(curve).first()[0] == pytest.approx(library(df, "areaUnderROC"), abs=1e-9)
    assert evaluate.area_under_pr(curve).first()[0] == pytest.approx(library(df, "areaUnderPR"), abs=1e-9)
    both = evaluate.binary_areas(df).first()
    assert both["auc_roc"] == pytest.approx(library(df, "areaUnderROC"), abs=1e-9)


def test_scores_all_tied(spark):
    df = scored(spark, [(0.5, 1.0), (0.5, 0.0), (0.5, 0.0), (0.5, 0.0)])
    row = evaluate.binary_areas(df).first()
    assert row["auc_roc"] == pytest.approx(0.5) and row["auc_pr"] == pytest.approx(0.25)


def test_one_class_only(spark):
    row = evaluate.binary_areas(scored(spark, [(0.1, 1.0), (0.9, 1.0)])).first()
    assert row["auc_roc"] is None and row["auc_pr"] == pytest.approx(1.0)


def test_two_thirds_of_rows_on_one_score(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.rand(1)).otherwise(0.4).alias("prediction"),
        (F.rand(2) < 0.5).cast("double").alias("label"),
    ).cache()
    curve = evaluate.threshold_curve(df, chunk_rows=100)
    assert evaluate.area_under_roc(curve).first()[0] == pytest.approx(library(df, "areaUnderROC"), abs=1e-9)
    assert curve.agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == 3000


def test_errors_and_accuracy(spark):
    df = scored(spark, [(1.0, 0.0), (3.0, 3.0), (0.0, 0.0), (-1.0, 0.0)])
    assert evaluate.mse(df).first()[0] == 0.5
    assert evaluate.rmse(df).first()[0] == pytest.approx(0.5**0.5)
    assert evaluate.accuracy(df, evaluate.margin_class()).first()[0] == 0.5
    assert evaluate.accuracy(df, evaluate.cut_class()).first()[0] == 0.5


def test_rmse_over_pairs_weighs_copies(spark):
    pairs = spark.createDataFrame([(1.0, 2.0, 3), (1.0, 1.0, 1)], "prediction double, rating double, n_rows long")
    assert evaluate.rmse_over_pairs(pairs).first()[0] == pytest.approx((3 / 4) ** 0.5)


def test_chunk_totals_share_the_shuffle_of_the_points(spark):
    df = spark.range(3000).select(F.rand(1).alias("prediction"), (F.rand(2) < 0.5).cast("double").alias("label"))
    path = scratch_path(spark, "scores")
    df.write.parquet(path)
    area = evaluate.area_under_roc(evaluate.threshold_curve(spark.read.parquet(path), chunk_rows=100))
    area.collect()
    assert "ReusedExchange" in area._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bits", [0, 3, 10])
def test_exact_areas_lie_within_the_summary_errors(spark, bits):
    rng = random.Random(bits)
    kinds = [lambda y: rng.gauss(y, 1), lambda y: rng.choice([0.0, -0.0, 1.0, 2.0, 4.0, -8.0, 0.25]), lambda y: 10 ** rng.uniform(-300, 300) * (y - 0.4), lambda y: 1.0]
    for kind in kinds:
        ys = [float(rng.random() < 0.3) for _ in range(500)]
        df = spark.createDataFrame([(kind(y), y) for y in ys] + [(None, 1.0), (1.0, None)], "prediction double, label double")
        exact = evaluate.binary_areas(df).first()
        found = evaluate.summary_areas(evaluate.score_summary(df, bits=bits)).first()
        for area, error in (("auc_roc", "roc_error"), ("auc_pr", "pr_error")):
            assert abs(found[area] - exact[area]) <= found[error] + 1e-12
        if bits == 10 and kind is kinds[0]:
            assert found["roc_error"] < 0.002 and found["pr_error"] < 0.02


def test_bins_never_fall_where_scores_rise(spark):
    scores = [0.0, 5e-324, 1e-310, 2.2e-308, 0.1, 0.999999, 1.0, 1.0000001, 7.999999999999999, 8.0, 8.000000000000002, 1e300, 1.7e308, float("inf")]
    scores = sorted([-s for s in scores] + scores + [2.0**k for k in range(-1074, 1024, 13)])
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s double")
    for bits in (0, 5, 20):
        bins = [r["b"] for r in rows.withColumn("b", evaluate.score_bin(F.col("s"), bits)).orderBy("i").collect()]
        assert bins == sorted(bins) and len(set(bins)) > 10


def test_summaries_of_parts_add_up(spark):
    df = spark.range(1000).select((F.rand(3) - 0.5).alias("prediction"), (F.col("id") % 2).cast("double").alias("label")).persist()
    parts = [evaluate.score_summary(df.filter(f"label = {y}")) for y in (0, 1)]
    merged = parts[0].unionByName(parts[1]).groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    assert tuple(evaluate.summary_areas(merged).first()) == tuple(evaluate.summary_areas(evaluate.score_summary(df)).first())
    none = evaluate.summary_areas(evaluate.score_summary(df.limit(0))).first()
    assert none["auc_roc"] is None and none["auc_pr"] is None
    df.unpersist()
