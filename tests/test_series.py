import math
import random

import pytest
from pyspark.sql import functions as F

from loomstat.operators import series


def brute(y):
    """The seven features straight from their definitions."""
    n = len(y)
    m = sum(y) / n
    sd = math.sqrt(sum((v - m) ** 2 for v in y) / n)
    z = [(v - m) / (sd if sd > 0 else 1.0) for v in y]
    mid = (n - 1) / 2
    xx = sum((i - mid) ** 2 for i in range(n))
    slope = sum((i - mid) * (v - m) for i, v in enumerate(y)) / xx if xx else None
    step = max(abs(a - b) for a, b in zip(z, [0.0, *z]))
    return [n, m, sd, slope, step] + [sum(abs(v) > k for v in z) for k in (1, 2, 3)]


def same(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert (a is None and b is None) or a == pytest.approx(b, abs=1e-9), (got, expected)


EDGE = {
    "constant": [4.0] * 6,
    "one": [3.0],
    "two": [3.0, 5.0],
    "ramp": [float(i) for i in range(20)],
    "spike": [0.0] * 15 + [50.0] + [0.0] * 5,
    "negative first": [-9.0, 1.0, 1.2, 0.8, 1.1],
}


def as_points(spark, named):
    cells = [(k, i, v) for k, y in named.items() for i, v in enumerate(y)]
    random.Random(1).shuffle(cells)
    return spark.createDataFrame(cells, "s string, i int, v double").repartition(5)


@pytest.mark.parametrize("chunk_rows", [2_000_000, 7])
def test_edge_series_long_and_wide(spark, chunk_rows):
    long = series.series_features(as_points(spark, EDGE), "s", "i", "i", "v", chunk_rows)
    arrays = spark.createDataFrame(list(EDGE.items()), "s string, points array<double>")
    wide = series.array_features(arrays, "points", ["s"])
    for df in (long, wide):
        found = {r["s"]: [r["n"], *[r[f] for f in series.FEATURES]] for r in df.collect()}
        assert set(found) == set(EDGE)
        for name, y in EDGE.items():
            same(found[name], brute(y))
    assert brute(EDGE["spike"])[-1] == 1 and brute(EDGE["ramp"])[3] == pytest.approx(1.0)


def test_one_series_with_most_points_is_cut_and_still_exact(spark):
    rnd = random.Random(3)
    named = {"hot": [rnd.gauss(0, 1) + (40 if i % 911 == 0 else 0) for i in range(6000)]}
    named |= {f"s{j}": [rnd.uniform(-5, 5) for _ in range(rnd.randrange(1, 60))] for j in range(40)}
    points = as_points(spark, named)
    got = series.series_features(points, "s", "i", "i", "v", 500)
    for r in got.collect():
        same([r["n"], *[r[f] for f in series.FEATURES]], brute(named[r["s"]]))
    scores = series.series_zscores(points, "s", "i", "i", "v", 500)
    hot = [r["z"] for r in scores.filter("s = 'hot'").orderBy("i").collect()]
    y = named["hot"]
    m = sum(y) / len(y)
    sd = math.sqrt(sum((v - m) ** 2 for v in y) / len(y))
    assert hot == pytest.approx([(v - m) / sd for v in y], abs=1e-9)
    assert scores.count() == sum(map(len, named.values()))


def test_points_move_once(spark):
    """One shuffle carries points (by series and chunk); others carry reduced rows."""
    points = as_points(spark, {"a": [1.0, 2.0], "b": [3.0]})
    df = series.series_features(points, "s", "i", "i", "v", 1)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "chunk" in plan
    windows = [line for line in plan.splitlines() if "Window [row_number" in line or "row_number()" in line]
    assert all("chunk" in line for line in windows)


def test_an_empty_array_has_no_features(spark):
    df = spark.createDataFrame([("e", [])], "s string, points array<double>")
    row = series.array_features(df, "points", ["s"]).first()
    assert row["n"] == 0 and row["ybar"] is None and row["slope"] is None


def test_a_filter_on_array_features_costs_folds_in_proportion(spark):
    df = spark.range(5).select("id", F.array(*[F.lit(float(i % 7)) for i in range(64)]).alias("points"))
    featured = series.array_features(df, "points", ["id"])

    def folds(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString().count("aggregate(")

    one = folds(featured.select("id", "ybar", "largest_delta"))
    assert folds(featured.dropna()) <= one * (1 + len(series.FEATURES))
