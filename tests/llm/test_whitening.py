import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS)
    return df.withColumns({c: F.lit(f"extra {c}") for c in ("_x", "_key", "n", "component", "whitened", "deviation")})


def plain(rows, components):
    """Covariance of the distinct vectors in one place, entries exact, and its eigenvectors."""
    left = [(k, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for k, v in rows if complete(v)]
    fits = sorted({tuple(x) for _, x in left})
    n, d = len(fits), len(fits[0])
    sums = [sum(x[j] for x in fits) for j in range(d)]
    centred = [[n * x[j] - sums[j] for j in range(d)] for x in fits]
    cov = [[Fraction(sum(r[i] * r[j] for r in centred), n**3) for j in range(d)] for i in range(d)]
    values, basis = np.linalg.eigh(np.array(cov, float))
    order = np.argsort(-values)[: min(components, d)]
    out = []
    for k, x in left:
        far = [n * a - s for a, s in zip(x, sums)]
        white = (np.array(far, float) / n) @ basis[:, order] / np.sqrt(values[order])
        out.append((k, sum(v * v for v in far), white))
    return n, out, values[order] / values.sum()


def complete(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def sample(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) @ np.diag(spread ** -np.arange(width)) @ np.linalg.qr(rng.normal(size=(width, width)))[0]
    return [(i, [float(c) for c in np.float32(row)]) for i, row in enumerate(x * 100)]


@pytest.mark.parametrize(("width", "spread"), [(5, 1.5), (20, 1.3), (1, 1.0)])
def test_rows_equal_the_plain_way(spark, width, spread):
    rows = sample(300, width, width, spread)
    rows += [(i % 7, rows[i % 3][1]) for i in range(150)]  # copies, repeated keys
    rows += [(None, rows[5][1]), (901, None), (902, []), (903, [None] * width), (904, [float("nan")] * width)]
    rows += [(905, [float("inf")] * width), (906, [1.0] * (width + 1))]
    got = whitening.whitened(vectors(spark, rows).repartition(3), components=16).collect()
    n, left, explained = plain([r for r in rows if r[0] != 906], 16)
    assert len(got) == len(left) * min(16, width)
    assert {r["n"] for r in got} == {n} and all(0 <= r["identity_error"] < 1e-9 for r in got)
    assert sorted({r["component"] for r in got}) == list(range(1, min(16, width) + 1))
    for j in range(min(16, width)):
        mine = {(r["vec_id"], int(r["deviation"]), round(abs(r["whitened"]), 6)) for r in got if r["component"] == j + 1}
        theirs = {(k, far, round(abs(float(w[j])), 6)) for k, far, w in left}
        assert {m[:2] for m in mine} == {t[:2] for t in theirs}
        for m, t in zip(sorted(mine, key=str), sorted(theirs, key=str)):
            assert m[2] == pytest.approx(t[2], abs=1e-5)
        share = next(r["explained"] for r in got if r["component"] == j + 1)
        assert share == pytest.approx(explained[j], rel=1e-9)


def test_columns_that_depend_on_each_other_and_vectors_without_spread(spark):
    rows = [(i, [float(c), float(c), 3.0, float(c + w)]) for i, (c, w) in enumerate(zip(range(50), [3, 1, 4, 1, 5] * 10))]
    got = whitening.whitened(vectors(spark, rows), components=4).collect()
    spread = {c: [r["whitened"] for r in got if r["component"] == c] for c in (1, 2, 3, 4)}
    assert all(v is not None for c in (1, 2) for v in spread[c]) and all(v is None for c in (3, 4) for v in spread[c])
    assert got[0]["identity_error"] < 1e-9
    shares = {r["component"]: r["explained"] for r in got}
    assert shares[3] == shares[4] == 0 and shares[1] + shares[2] == pytest.approx(1)
    same = whitening.whitened(vectors(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0]), (2, [2.0, 3.0])])).collect()
    assert len(same) == 6 and all(r["whitened"] is r["explained"] is r["identity_error"] is None for r in same)
    assert {(r["n"], int(r["deviation"])) for r in same} == {(1, 0)}


def test_nothing_to_fit(spark):
    for rows in ([], [(1, None), (2, [float("nan")])]):
        found = whitening.whitened(vectors(spark, rows))
        assert found.collect() == [] and found.columns[:2] == ["vec_id", "component"]


def test_small_eigenvalues_keep_their_digits(spark):
    """Eigenvalues from 1 down to 1e-14 of the largest: a plain Gram matrix loses the least ones."""
    rng = np.random.default_rng(8)
    x = np.rint(rng.normal(size=(400, 4)) * [1e9, 1e7, 1e4, 1e2]).astype(np.int64)
    df = spark.createDataFrame([([int(c) for c in row],) for row in x], "_x array<long>")
    model, _ = whitening.fit(df, 4)
    exact = np.linalg.svd((x - x.mean(0)), compute_uv=False) ** 2 / len(x)
    assert model.eigenvalues == pytest.approx(exact, rel=1e-6) and model.passes >= 3


def test_exact_arithmetic_beyond_the_longs():
    rng = random.Random(1)
    for bound in (100, 2**40, 2**61):
        x = np.array([[rng.randrange(-bound, bound) for _ in range(300)] for _ in range(4)])
        sums = [int(s) for s in x.astype(object).sum(0)]
        d = whitening.deviations(x, 4, sums)
        want = [[4 * int(v) - s for v, s in zip(row, sums)] for row in x]
        assert [[int(v) for v in row] for row in d] == want
        assert whitening.squared_lengths(d) == [sum(v * v for v in row) for row in want]


def test_rows_are_not_shuffled(spark):
    rows = whitening.whole_numbers(vectors(spark, sample(20, 3, 0)).select("vec_id", "embedding"), "embedding")
    model, _ = whitening.fit(rows, 2)
    plan = whitening.transform(rows, model, ["vec_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
