import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.operators import factorize as A
from loomstat.operators import recommend
from loomstat.operators.sampling import BUCKETS, key_bucket


def table(spark, seed, hot=0, negative=False):
    rng = random.Random(seed)
    cells = [(u, p, float(rng.randrange(-3 if negative else 1, 6))) for u in range(25) for p in range(18) if rng.random() < 0.3]
    cells += [(99, p % 18 + 18 * (p // 18), float(1 + p % 5)) for p in range(hot)]
    return spark.createDataFrame(cells + cells[:5], "user int, product int, rating double").repartition(3), cells


def starts(spark, ids, rank, seed):
    keys = spark.createDataFrame([(i, j) for i in ids for j in range(rank)], "i int, j int")
    rows = keys.select("i", "j", key_bucket(F.lit(seed), F.col("i"), F.col("j")).alias("h")).collect()
    return {i: np.array([r["h"] / BUCKETS / rank**0.5 for r in sorted(rows, key=lambda r: r["j"]) if r["i"] == i]) for i in ids}


def dense(cells, users, items, rank, iterations, reg, implicit):
    """One system per key, in numpy, from the same starts."""

    def solved(fixed, mine, theirs):
        base = sum(np.outer(f, f) for f in fixed.values()) if implicit else np.zeros((rank, rank))
        out = {}
        for key in {c[mine] for c in cells}:
            a, b, n = base.copy(), np.zeros(rank), 0
            for c in cells:
                if c[mine] == key:
                    f, r = fixed[c[theirs]], c[2]
                    w = abs(r) if implicit else 1.0
                    a += w * np.outer(f, f)
                    b += f * ((1 + w) * (r > 0) if implicit else r)
                    n += (r > 0) if implicit else 1
            out[key] = np.linalg.solve(a + reg * n * np.eye(rank), b)
        return out

    for _ in range(iterations):
        items = solved(users, 1, 0)
        users = solved(items, 0, 1)
    return users, items


def as_dict(df):
    rows = df.collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: np.array(r["features"]) for r in rows}


@pytest.mark.parametrize("implicit", [False, True])
@pytest.mark.parametrize(("hot", "part"), [(0, 1_000_000), (400, 30)])
def test_equals_dense_least_squares(spark, implicit, hot, part):
    """Also with one user who has most of the ratings, dealt to many parts."""
    df, cells = table(spark, 1 + hot, hot, negative=implicit)
    rank, reg = 4, 0.1
    first = [starts(spark, sorted({c[k] for c in cells}), rank, k) for k in (0, 1)]
    users, items = dense(cells, *first, rank, 3, reg, implicit)
    model = A.factorize(df, rank, 3, reg, implicit, part_ratings=part)
    for found, want in ((as_dict(model.userFactors), users), (as_dict(model.itemFactors), items)):
        assert found.keys() == want.keys()
        for key in want:
            assert found[key] == pytest.approx(want[key], abs=1e-6)


def test_a_heavy_key_is_dealt_to_parts_of_bounded_size(spark):
    df, _ = table(spark, 3, 900)
    placed = A.with_parts(df, "user", "product", 50)
    sizes = {(r["user"], r["part"]): r["n"] for r in placed.groupBy("user", "part").agg(F.count("*").alias("n")).collect()}
    assert len([k for k in sizes if k[0] == 99]) == 18 and max(sizes.values()) < 100
    assert all(part == 0 for user, part in sizes if user != 99)
    step = A.half_step(df, A.start_factors(df.select(F.col("product").alias("id")).distinct(), 3), 3, 0.1, part_ratings=50)
    assert step.filter("id = 99").count() == 1


def test_singular_systems_and_missing_sides(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 2.0), (2, 7, 1.0)], "user int, product int, rating double")
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0])], "id int, features array<double>")
    found = as_dict(A.half_step(df, items, 2, 0.0))
    assert found.keys() == {1} and found[1] == pytest.approx([2.0, 0.0])
    none = A.factorize(df.filter("user > 9"), 2, 2)
    assert none.userFactors.collect() == [] and none.itemFactors.columns == ["id", "features"]


def test_scores_and_top_items_take_the_model(spark):
    df, cells = table(spark, 4)
    model = A.factorize(df, 3, 8, 0.05)
    users, items = as_dict(model.userFactors), as_dict(model.itemFactors)
    scored = recommend.score_pairs(model, df.select("user", "product").distinct()).collect()
    assert all(r["prediction"] == pytest.approx(users[r["user"]] @ items[r["product"]]) for r in scored)
    error = np.mean([(r["prediction"] - dict(((u, p), x) for u, p, x in cells)[r["user"], r["product"]]) ** 2 for r in scored])
    assert error < 1.5
    best = sorted(((-(users[3] @ f), p) for p, f in items.items()))[:10]
    got = recommend.top_items(model, 3, 10).collect()
    assert [r["product"] for r in got] == [p for _, p in best]
    assert [r["rating"] for r in got] == pytest.approx([-s for s, _ in best])
