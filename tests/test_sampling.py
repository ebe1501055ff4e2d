import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomstat.operators import sampling


def table(spark, n, seed, parts=3):
    rng = random.Random(seed)
    rows = [(rng.choice([i, i, i % 40, None]), rng.choice(["a", "a", "a", "a", "b", None]), i) for i in range(n)]
    return spark.createDataFrame(rows, "id long, c string, v int").repartition(parts, "v")


def least(df, k):
    """ORDER BY hash, tie LIMIT k per class, on one machine."""
    rows = df.withColumn("h", sampling.key_bucket(F.col("id"))).collect()
    out = Counter()
    for c in {r["c"] for r in rows}:
        mine = sorted((r["h"], r["v"]) for r in rows if r["c"] == c)
        out.update((c, v) for _, v in mine[: k if isinstance(k, int) else k.get(c, 0)])
    return out


@pytest.mark.parametrize("k", [0, 1, 37, 10_000, {"a": 100, None: 5}])
@pytest.mark.parametrize("rows_at_once", [4096, 3])
def test_equals_the_least_hashes_per_class(spark, monkeypatch, k, rows_at_once):
    monkeypatch.setattr(sampling, "SELECT_ROWS", rows_at_once)
    monkeypatch.setattr(sampling, "SELECT_BITS", 4 if rows_at_once == 3 else 10)
    df = table(spark, 1500, 1)
    found = sampling.bottom_k(df, "id", k, by="c", tie=["v"])
    assert found.columns == df.columns
    assert Counter((r["c"], r["v"]) for r in found.collect()) == least(df, k)


def test_partitions_do_not_matter_and_equal_rows_fill_up(spark):
    first = sampling.bottom_k(table(spark, 500, 2, 1), "id", 50, tie=["v"])
    again = sampling.bottom_k(table(spark, 500, 2, 7), "id", 50, tie=["v"])
    assert sorted(r["v"] for r in first.collect()) == sorted(r["v"] for r in again.collect())
    same = spark.range(1000).select(F.lit(5).alias("id"))
    assert sampling.bottom_k(same, "id", 10).count() == 10
    assert sampling.bottom_k(same.limit(0), "id", 10).columns == ["id"]


def test_many_classes_make_one_plan(spark):
    df = spark.range(3000).select("id", (F.col("id") % 300).alias("c"))
    found = sampling.bottom_k(df, "id", 4, by="c")
    assert found.groupBy("c").count().filter("count <> 4").count() == 0 and found.count() == 1200
