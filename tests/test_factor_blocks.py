"""Half-steps that read factors from the shared folder, against the library's fit and plain least squares."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.operators import factor_blocks as B
from loomstat.operators import recommend
from loomstat.session import shared_folder


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(6)
    cells = [(u, p, float(rng.randrange(-2, 6))) for u in range(40) for p in range(25) if rng.random() < 0.3 or u == 7]
    return spark.createDataFrame(cells + cells[:9], "user int, product int, rating double").repartition(3)


@pytest.fixture
def small_pieces(spark, monkeypatch):
    """Pieces are cut between batches of rows."""
    monkeypatch.setattr(B, "PIECE_RATINGS", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def as_dict(df):
    rows = df.collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: r["features"] for r in rows}


@pytest.mark.parametrize("implicit", [False, True])
def test_equals_the_library(spark, small_pieces, ratings, implicit):
    before = set(os.listdir(f"{shared_folder(spark)}/loomstat")) if os.path.isdir(f"{shared_folder(spark)}/loomstat") else set()
    mine = recommend.fit_als(ratings, 3, 2, 0.1, implicit, seed=2, sent_bytes=0)
    new = [x for x in os.listdir(f"{shared_folder(spark)}/loomstat") if x not in before]
    assert sorted(x.split("-")[0] for x in new) == ["factors", "factors", "model", "pairs"]  # earlier factors are gone
    library = recommend.fit_als(ratings, 3, 2, 0.1, implicit, seed=2)
    for found, want in ((as_dict(mine.userFactors), as_dict(library.userFactors)), (as_dict(mine.itemFactors), as_dict(library.itemFactors))):
        assert found.keys() == want.keys()
        assert all(found[k] == pytest.approx(want[k], abs=1e-5) for k in want)
    user = spark.createDataFrame([(7,)], "user int")
    best, same = (m.recommendForUserSubset(user, 4).first()["recommendations"] for m in (mine, library))
    assert [r["product"] for r in best] == [r["product"] for r in same]


def test_a_half_step_shuffles_nothing(spark, small_pieces, ratings):
    """One task per block, and two without rows; the factors are read, not sent."""
    pairs = recommend.written(recommend.mean_per_pair(ratings, recommend.PAIR), "pairs")
    path, layout = B.laid_out(pairs, "user", "product", 5)
    pieces = spark.read.parquet(path)
    assert len(layout) == 5 and pieces.count() > 25 and pieces.agg(F.sum(F.length("ratings") / 4)).first()[0] == pairs.count()
    items = pairs.select(F.col("product").alias("id")).distinct().select("id", F.array(F.col("id") * 0.1, F.lit(1.0)).alias("features"))
    chunks = recommend.written(B.chunked(items, 5), "factors")
    step = B.half_step(layout, chunks, 2, 0.5)
    assert "Exchange" not in step._jdf.queryExecution().executedPlan().toString()
    assert step.rdd.getNumPartitions() == 7
    found, cells = as_dict(B.unchunked(step, 2)), pairs.collect()
    assert found.keys() == {c["user"] for c in cells}
    for user, features in found.items():
        own = [c for c in cells if c["user"] == user]
        f, r = np.array([[c["product"] * 0.1, 1.0] for c in own]), np.array([c["rating"] for c in own])
        assert features == pytest.approx(np.linalg.solve(f.T @ f + 0.5 * len(own) * np.eye(2), f.T @ r), abs=1e-4)


@pytest.mark.parametrize("cells", [4, 20, 2_000_000])
@pytest.mark.parametrize("implicit", [False, True])
def test_equations_are_added_in_slices(monkeypatch, cells, implicit):
    """Also of keys with more ratings than a slice holds."""
    monkeypatch.setattr(B, "CELLS", cells)
    rng = np.random.default_rng(3)
    key = np.r_[np.zeros(17, int), np.arange(9), rng.integers(0, 9, 30)]
    f, r = rng.random((len(key), 2)).astype(np.float32), rng.integers(-2, 4, len(key)).astype(np.float32)
    base = np.eye(2) if implicit else np.zeros((2, 2))
    found = B._factors(key, f, r, 0.3, implicit, 2.0, base)
    for k in range(9):
        own, x = f[key == k].astype(float), r[key == k].astype(float)
        w, right, n = (2 * abs(x), (1 + 2 * abs(x)) * (x > 0), (x > 0).sum()) if implicit else (np.ones(len(x)), x, len(x))
        want = np.linalg.solve(base + (own.T * w) @ own + 0.3 * n * np.eye(2), own.T @ right)
        assert found[k] == pytest.approx(want, abs=1e-5)


def test_chunks_before_the_pieces_and_blocks_in_rounds(spark, ratings):
    """Files of a partition may be read in any order."""
    pairs = recommend.written(recommend.mean_per_pair(ratings, recommend.PAIR), "pairs")
    _, layout = B.laid_out(pairs, "user", "product", 2)
    items = pairs.select(F.col("product").alias("id")).distinct().select("id", F.array(F.col("id") * 0.1, F.lit(1.0)).alias("features"))
    chunks = recommend.written(B.chunked(items, 2), "factors")
    want = as_dict(B.unchunked(B.half_step(layout, chunks, 2, 0.5), 2))
    none = [F.lit(None).cast("binary").alias(c) for c in ("keys", "counts", "others", "places", "ratings")]
    first = chunks.select(F.lit(-1).alias("block"), F.lit(None).cast("int").alias("of"), F.col("block").alias("part"), *none, "ids", "features")
    turned = [first.coalesce(1).unionAll(one).coalesce(1) for one in layout]
    no_rows = chunks.filter("block < 0")
    assert as_dict(B.unchunked(B.half_step(turned, no_rows, 2, 0.5), 2)) == want
    assert B.block_count(173_000_000, 10, 12) == 36 and B.block_count(1000, 10, 8) == 16
