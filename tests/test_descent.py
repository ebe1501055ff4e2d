import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.mllib.classification import SVMWithSGD
from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
from pyspark.sql import functions as F

from loomstat.operators import descent
from loomstat.operators.sampling import in_share
from loomstat.operators.features import assemble
from loomstat.plans.catalog.models import EDGE, huber

RND = np.random.default_rng(11)
X = RND.uniform(-1, 1, size=(200, 3))
Y = X @ np.array([1.5, -2.0, 0.0]) + RND.normal(0, 0.1, 200)
FLAG = (X @ np.array([1.0, -1.0, 0.2]) > 0.1).astype(float)
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    cells = [(i, float(y), float(f), *map(float, x)) for i, (x, y, f) in enumerate(zip(X, Y, FLAG))]
    return spark.createDataFrame(cells, "id int, y double, flag double, a double, b double, c double").cache()


def points(spark, labels):
    return spark.sparkContext.parallelize([LabeledPoint(float(l), x.tolist()) for l, x in zip(labels, X)], 2).cache()


@pytest.mark.parametrize("reg", ["NONE", "L1", "L2"])
def test_linear_equals_the_library_with_early_stop(spark, rows, reg):
    mine = descent.linear_regression(rows, "y", NAMES, 100, 1.0, reg, 0.1)
    library = LinearRegressionWithSGD.train(
        points(spark, Y), 100, 1.0, 1.0, regParam=0.1, regType=None if reg == "NONE" else reg.lower(), intercept=False
    )
    assert mine.weights == pytest.approx(library.weights.toArray().tolist(), abs=1e-6)
    assert len(mine.losses) < 100


def test_svm_equals_the_library(spark, rows):
    mine = descent.linear_svm(rows, "flag", NAMES, 60, 1.0, "L1", 0.05)
    library = SVMWithSGD.train(points(spark, FLAG), 60, 1.0, 0.05, 1.0, regType="l1", intercept=False)
    assert mine.weights == pytest.approx(library.weights.toArray().tolist(), abs=1e-6)


@pytest.mark.parametrize("reg", ["NONE", "L1", "L2"])
def test_products_and_rows_give_the_same_steps(rows, reg):
    same_gradient = descent.LinearGradient(descent.least_squares.pull)
    one = descent.descend(rows, "y", NAMES, descent.least_squares, reg, 0.7, 12, 0.2, tolerance=0.0)
    two = descent.descend(rows, "y", NAMES, same_gradient, reg, 0.7, 12, 0.2, tolerance=0.0)
    assert one.weights == pytest.approx(two.weights, abs=1e-10)
    assert one.losses == pytest.approx(two.losses, abs=1e-10)
    assert len(one.losses) == 12 and one.losses[-1] < one.losses[0]


def test_l1_shrinks_to_a_plain_zero(rows):
    model = descent.linear_regression(rows, "y", NAMES, 30, 1.0, "L1", 0.5)
    assert model.weights[2] == 0.0 and math.copysign(1, model.weights[2]) == 1.0


def test_a_callers_gradient_is_honoured(rows):
    model = descent.descend(
        rows.select("y", F.lit(1.0).alias("one"), "a"), "y", ["one", "a"], huber, "NONE", 0.15, 5, 0.1,
        tolerance=0.0,
    )
    w = np.zeros(2)
    for i in range(1, 6):
        error = w[0] + w[1] * X[:, 0] - Y
        pull = error.clip(-EDGE, EDGE)
        w = w - 0.15 / math.sqrt(i) * np.array([pull.mean(), (pull * X[:, 0]).mean()])
    assert model.weights == pytest.approx(w.tolist(), abs=1e-9)


def test_batches_do_not_depend_on_partitions(rows):
    def run(df):
        return descent.descend(
            df, "y", NAMES, descent.least_squares, "L2", 0.5, 6, 0.1, batch_share=0.3, batch_key="id", tolerance=0.0
        )

    one, two = run(rows), run(rows.repartition(7))
    assert one.weights == pytest.approx(two.weights, abs=1e-12)
    assert one.weights != pytest.approx(descent.linear_regression(rows, "y", NAMES, 6, 0.5, tolerance=0.0).weights)
    with pytest.raises(ValueError, match="batch_key"):
        descent.descend(rows, "y", NAMES, batch_share=0.5)


def test_no_rows_leave_the_start(rows):
    empty = rows.filter("id < 0")
    for gradient in (descent.least_squares, descent.hinge):
        model = descent.descend(empty, "y", NAMES, gradient, initial=[1.0, 2.0, 3.0])
        assert model.weights == [1.0, 2.0, 3.0] and model.losses == []
    model = descent.descend(assemble(empty, NAMES), "y", "features", initial=[1.0, 2.0, 3.0])
    assert model.weights == [1.0, 2.0, 3.0] and model.losses == []


def test_literal_points(rows, spark):
    weights = [0.1 * (j + 1) for j in range(10)]
    data = spark.createDataFrame([tuple(float(i) for i in range(1, 11)), (3.0,) * 10], [f"x{j}" for j in range(10)])
    got = [r[0] for r in data.select(descent.dot([F.col(c) for c in data.columns], weights)).collect()]
    assert got == pytest.approx([38.5, 16.5])


@pytest.mark.parametrize("name,reg", [("least_squares", "L2"), ("hinge", "L1")])
def test_vectors_take_the_same_steps_as_columns(rows, name, reg):
    gradient = descent.LinearGradient(getattr(descent, name).pull)
    label = "flag" if name == "hinge" else "y"
    one = descent.descend(rows, label, NAMES, gradient, reg, 0.7, 8, 0.05, tolerance=0.0)
    vectors = assemble(rows, NAMES)
    two = descent.descend(vectors, label, "features", gradient, reg, 0.7, 8, 0.05, tolerance=0.0)
    assert one.weights == pytest.approx(two.weights, abs=1e-10)
    assert one.losses == pytest.approx(two.losses, abs=1e-10)
    scores = vectors.select(descent.margin(NAMES, one.weights), descent.margin("features", one.weights)).collect()
    assert all(a == pytest.approx(b, abs=1e-12) for a, b in scores)
    with pytest.raises(ValueError, match="linear gradient"):
        descent.descend(vectors, label, "features", huber)


def test_sparse_wide_vectors(spark):
    cells = [(float(i % 2), Vectors.sparse(5000, [i % 7, 4000 + i % 3], [1.0, float(i % 2)])) for i in range(60)]
    df = spark.createDataFrame(cells, ["label", "features"])
    model = descent.linear_svm(df, "label", "features", 5, 1.0, reg_param=0.0)
    assert len(model.weights) == 5000 and sum(w != 0 for w in model.weights) <= 10
    assert model.losses[-1] < model.losses[0]


def test_a_small_sample_reads_its_share_of_the_rows_only(spark):
    data = spark.range(20_000).select(F.col("id").alias("_key"), F.lit(1.0).alias("_label")).repartition(8)
    batch = descent._batches(data, 0.01, 100)
    sizes = []
    for i in (1, 2, 77, 100):
        step = batch(i)
        keys = {r["_key"] for r in step.collect()}
        want = data.filter(in_share(0.01, F.col("_key"), F.lit(i)))
        assert keys == {r["_key"] for r in want.collect()}
        scan = step._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        sizes.append(scan.metrics().get("numOutputRows").get().value())
        assert sizes[-1] == len(keys)
    assert all(100 < n < 320 for n in sizes)


def test_wide_rows_take_one_pass(spark, monkeypatch):
    """500 features: the same weights as step by step, and every step but the first costs no job."""
    rng = np.random.default_rng(3)
    names = [f"f{j}" for j in range(500)]
    x = rng.normal(size=(120, 500)) / 10
    cells = [(*map(float, r), float(y)) for r, y in zip(x, x @ rng.normal(size=500))] + [(None, *[1.0] * 499, 1.0)]
    df = spark.createDataFrame(cells, [*names, "y"]).repartition(3)
    monkeypatch.setattr(descent, "_from_rows", None)  # not reached
    wide = descent.linear_regression(df, "y", names, 30, 0.5, "L1", 0.001, 0.0)
    w, losses = np.zeros(500), []
    y = np.array([c[-1] for c in cells[:-1]])
    for i in range(1, 31):
        error = x @ w - y
        losses.append(float((error @ error) / 240 + 0.001 * np.abs(w).sum()))
        w, _ = descent.l1_penalty(w, x.T @ error / 120, 0.5 / np.sqrt(i), 0.001)
    assert wide.weights == pytest.approx(list(w), abs=1e-9) and wide.losses == pytest.approx(losses)
    assert descent.linear_regression(df.limit(0), "y", names, 3).losses == []
