import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from loomstat.operators import trees
from loomstat.operators.features import assemble

XS = ["a", "b", "c"]


def table(spark, n, seed, classes):
    rng = random.Random(seed)
    cells = []
    for i in range(n):
        a, b, c = rng.randrange(6), rng.randrange(9) / 4, rng.choice([0.5, 1.5])
        y = (a > 2) + (b > 1.2) * (c > 1) if classes == 3 else int(a * b > 3) if classes == 2 else a * b + rng.random()
        cells.append((i, float(a), float(b), c, float(rng.randrange(classes) if classes and rng.random() < 0.1 else y)))
    return spark.createDataFrame(cells, "id int, a double, b double, c double, y double").repartition(3), cells


def impurity(kind, ys):
    if kind == "Variance":
        return float(np.var(ys)) if len(ys) else 0.0
    shares = [np.mean(np.array(ys) == c) for c in set(ys)]
    return 1 - sum(p * p for p in shares) if kind == "Gini" else -sum(p * math.log2(p) for p in shares)


def plain(cells, kind, depth, cuts, heap=1, out=None):
    """Every cut of every feature tried at every node."""
    out = {} if out is None else out
    ys = [c[4] for c in cells]
    before, best = impurity(kind, ys), None
    for f in range(3) if depth else ():
        for t in cuts[f]:
            low, high = [c[4] for c in cells if c[1 + f] <= t], [c[4] for c in cells if c[1 + f] > t]
            if low and high:
                gain = before - (len(low) * impurity(kind, low) + len(high) * impurity(kind, high)) / len(ys)
                if before and gain / before > 1e-12 and (best is None or round(gain / before, 12) > best[0]):
                    best = (round(gain / before, 12), f, t)
    out[heap] = (XS[best[1]], best[2], len(ys)) if best else (None, None, len(ys))
    if best:
        plain([c for c in cells if c[1 + best[1]] <= best[2]], kind, depth - 1, cuts, 2 * heap, out)
        plain([c for c in cells if c[1 + best[1]] > best[2]], kind, depth - 1, cuts, 2 * heap + 1, out)
    return out


@pytest.mark.parametrize(("kind", "classes"), [("Gini", 3), ("Entropy", 3), ("Gini", 2), ("Variance", 0)])
def test_splits_equal_trying_every_cut(spark, kind, classes):
    df, cells = table(spark, 400, classes + len(kind), classes)
    algo = "Regression" if kind == "Variance" else "Classification"
    tree = trees.grow(df, "y", XS, algo, 4, kind)
    values = [sorted({c[1 + f] for c in cells}) for f in range(3)]
    want = plain(cells, kind, 4, [[(p + q) / 2 for p, q in zip(v, v[1:])] for v in values])
    got = {r["node"]: (r["feature"], r["threshold"], int(r["n"])) for r in trees.node_table(spark, tree).collect()}
    assert got == want
    scored = df.withColumn("p", trees.predict(tree)).collect()
    if classes:
        library = DecisionTreeClassifier(maxDepth=4, impurity=kind.lower(), maxBins=100, labelCol="y")
        theirs = library.fit(assemble(df, XS)).transform(assemble(df, XS)).filter("prediction = y").count()
        assert abs(sum(r["p"] == r["y"] for r in scored) - theirs) <= 4
    else:
        library = DecisionTreeRegressor(maxDepth=4, maxBins=100, labelCol="y").fit(assemble(df, XS))
        theirs = {r["id"]: r["prediction"] for r in library.transform(assemble(df, XS)).collect()}
        assert all(r["p"] == pytest.approx(theirs[r["id"]]) for r in scored)


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select((F.col("id") % 997).cast("double").alias("a"), F.rand(1).alias("b"))
    df = df.withColumn("y", F.when(F.col("a") > 500, 1.0).otherwise(0.0))
    tree = trees.grow(df, "y", ["b", "a"], max_depth=2, max_bins=20)
    assert tree.feature[0] == 1 and 430 < tree.threshold[0] < 570
    found = df.withColumn("p", trees.predict(tree)).filter("p = y").count()
    assert found > 4500


def test_missing_values_and_nothing(spark):
    rows = [(1.0, 0.0), (2.0, 0.0), (3.0, 7.0), (4.0, 7.0), (None, 7.0), (float("nan"), 0.0), (5.0, None)]
    df = spark.createDataFrame(rows, "a double, y double")
    tree = trees.grow(df, "y", ["a"])
    assert tree.threshold[0] == 2.5 and tree.size(0) == 4 and len(tree.heap) == 3
    assert [r["p"] for r in df.withColumn("p", trees.predict(tree)).collect()] == [0, 0, 7, 7, None, None, 7]
    one = trees.grow(df.filter("y = 0"), "y", ["a"])
    assert one.heap == [1] and one.value(0) == 0
    none = trees.grow(df.limit(0), "y", ["a"])
    assert none.heap == [] and df.withColumn("p", trees.predict(none)).filter("p is not null").count() == 0
    mean = trees.grow(df.limit(0), "y", ["a"], "Regression", impurity="Variance")
    assert mean.heap == []
    with pytest.raises(ValueError):
        trees.grow(df, "y", ["a"], "Regression", impurity="Gini")


def test_a_level_counts_the_smaller_children_only(spark, monkeypatch):
    df, cells = table(spark, 300, 5, 2)
    counted = []
    real = trees._counted
    monkeypatch.setattr(trees, "_counted", lambda rows, node, wanted, stats: counted.append(list(wanted)) or real(rows, node, wanted, stats))
    tree = trees.grow(df, "y", XS, max_depth=3)
    assert counted[0] == [0]
    for level in counted[1:]:
        for i in level:
            sibling = next(k for k in range(len(tree.heap)) if tree.heap[k] == tree.heap[i] ^ 1)
            assert tree.size(i) <= tree.size(sibling)
