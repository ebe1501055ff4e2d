import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.operators import classify, clustering, descent, quasi_newton
from loomstat.operators.features import assemble

XS = ["a", "b", "c"]


def table(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [rng.gauss(0, 1), rng.gauss(1, 2), rng.gauss(0, 0.1)]
        rows.append((*x, float(rng.random() < 1 / (1 + np.exp(-(1.5 * x[0] - 0.5 * x[1]))))))
    return spark.createDataFrame([*rows, (None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)], [*XS, "label"]), np.array(rows)


@pytest.mark.parametrize(("reg_type", "reg_param"), [("L1", 0.05), ("L2", 0.1), ("L1", 0.3)])
def test_equals_the_library(spark, reg_type, reg_param):
    df, _ = table(spark)
    found = quasi_newton.fit(df, "label", XS, descent.log_loss, reg_type, reg_param, tolerance=1e-9)
    vectors = assemble(df.dropna(), XS).select("label", "features")
    theirs = classify.fit_logistic(vectors, 500, reg_type, reg_param, False, 1e-12)
    assert found.weights == pytest.approx(list(theirs.coefficients), abs=1e-4)
    assert [w == 0 for w in found.weights] == [w == 0 for w in theirs.coefficients]
    assert all(a >= b for a, b in zip(found.losses, found.losses[1:])) and len(found.losses) < 40
    sparse = quasi_newton.fit(vectors, "label", "features", descent.log_loss, reg_type, reg_param, tolerance=1e-9)
    assert sparse.weights == pytest.approx(found.weights, abs=1e-6)


def test_a_loss_of_ones_own(spark):
    df, rows = table(spark)

    def smooth(label, features, weights):
        """log cosh of the error: a caller's loss that no other operator has."""
        error = descent.dot(features, weights) - label
        return [F.tanh(error) * x for x in features], F.log(F.cosh(error))

    x, y = rows[:, :3], rows[:, 3]
    for reg_type, l1, l2 in (("NONE", 0, 0), ("L2", 0, 0.2), ("L1", 0.02, 0)):
        w = np.array(quasi_newton.fit(df, "label", XS, smooth, reg_type, l1 + l2, tolerance=1e-10).weights)
        gradient = (np.tanh(x @ w - y)[:, None] * x).mean(0) + l2 * w
        assert np.abs(quasi_newton._pseudo_gradient(w, gradient, l1)).max() < 1e-5


def test_a_try_is_one_aggregate(spark, monkeypatch):
    df, _ = table(spark)
    jobs = []
    real = descent._from_rows
    monkeypatch.setattr(descent, "_from_rows", lambda *a: (lambda m: lambda w, i: jobs.append(1) or m(w, i))(real(*a)))
    found = quasi_newton.fit(df, "label", XS, descent.log_loss, "L2", 0.1)
    assert len(jobs) <= 2 * len(found.losses) + 2


def test_no_rows_and_bad_parameters(spark):
    df, _ = table(spark)
    assert quasi_newton.fit(df.limit(0), "label", XS, descent.log_loss, initial=[1.0, 2.0, 3.0]).weights == [1, 2, 3]
    with pytest.raises(ValueError):
        quasi_newton.fit(df, "label", XS, descent.log_loss, "L3")


def points(spark, parts):
    rng = random.Random(7)
    cells = [(i, rng.gauss(i % 4 * 10, 1), rng.gauss(i % 2 * 20, 1)) for i in range(400)]
    cells += [(None, 1.0, 1.0), (999, None, 1.0)]
    return spark.createDataFrame(cells, "id int, x double, y double").repartition(parts)


def test_seeds_lie_apart_and_do_not_depend_on_partitions(spark):
    one = clustering.oversampled_seeds(points(spark, 1), ["x", "y"], "id", 4)
    assert one == clustering.oversampled_seeds(points(spark, 6), ["x", "y"], "id", 4)
    assert {(round(x / 10), round(y / 20)) for x, y in one} == {(0, 0), (1, 1), (2, 0), (3, 1)}
    assert one != clustering.oversampled_seeds(points(spark, 1), ["x", "y"], "id", 4, seed=5)
    fewer = points(spark, 2).filter("id < 2")
    assert len(clustering.oversampled_seeds(fewer, ["x", "y"], "id", 5, rounds=8)) == 2
    assert clustering.oversampled_seeds(fewer.limit(0), ["x", "y"], "id", 5) == []
    same = fewer.select("id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    assert clustering.oversampled_seeds(same, ["x", "y"], "id", 3) == [[1.0, 2.0]]
