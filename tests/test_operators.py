import random

import pytest
from pyspark.sql import functions as F

from loomstat.operators import joins, ordering, relational, sampling
from loomstat.operators.partitions import at_least_partitions, held


def test_join_counts_stand_for_all_joined_rows(spark):
    pred = spark.createDataFrame([(1, 1, 2.0), (1, 1, 2.0), (2, 1, 3.0), (9, 9, 1.0)], "user int, product int, prediction double")
    real = spark.createDataFrame([(1, 1, 4.0), (1, 1, 4.0), (1, 1, 5.0), (2, 1, 1.0), (3, 3, 1.0)], "user int, product int, rating double")
    got = relational.join_pairs(pred, real, ["user", "product"])
    plain = pred.join(real, ["user", "product"])
    expected = plain.groupBy("user", "product", "prediction", "rating").agg(F.count("*").alias("n_rows"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_profile_listing_share(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None)], "user int, product int")
    assert tuple(relational.ratings_profile(df).first()) == (3, 2, 2)
    assert [tuple(r) for r in relational.column_listing(df).collect()] == [(1, "user", 3), (2, "product", 2)]
    assert relational.predicate_share(df, F.col("product") > 1).first()[0] == pytest.approx(1 / 3)


def test_row_index_over_many_partitions(spark):
    values = [random.Random(5).randrange(1000) for _ in range(5000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int").repartition(7)
    got = ordering.with_row_index(df, [F.col("v").desc(), F.col("i").asc()]).collect()
    expected = sorted(((v, i) for i, v in enumerate(values)), key=lambda r: (-r[0], r[1]))
    assert [(r["v"], r["i"]) for r in sorted(got, key=lambda r: r["row_index"])] == expected
    assert sorted(r["row_index"] for r in got) == list(range(1, 5001))


def check_chunks(df, chunk_rows):
    rows = ordering.with_ordered_chunks(df, "o", "t", ordering.chunk_count(df, chunk_rows)).select("o", "t", "chunk").collect()
    ordered = sorted(rows, key=lambda r: (r["o"], r["t"]))
    chunks = [r["chunk"] for r in ordered]
    assert chunks == sorted(chunks), "chunk numbers must rise with the order"
    sizes = {c: chunks.count(c) for c in set(chunks)}
    assert len(rows) == df.count()
    return sizes


def test_chunks_are_ordered_and_bounded(spark):
    df = spark.range(10_000).select(F.col("id").alias("o"), F.lit(0).alias("t"))
    sizes = check_chunks(df, 500)
    assert len(sizes) >= 15 and max(sizes.values()) <= 1500


def test_one_order_value_with_most_rows_is_cut_by_the_tie(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(5000)).alias("o"),
        (F.col("id") * 7919 % 10_007).alias("t"),
    )
    sizes = check_chunks(df, 500)
    assert max(sizes.values()) <= 1500


def test_chunks_by_time_columns(spark):
    for kind in ("timestamp", "timestamp_ntz", "date"):
        df = spark.range(4000).select(
            F.expr(f"cast(timestampadd(HOUR, cast(id as int) * 7, timestamp'2024-03-01 00:00:00') as {kind})").alias("o"),
            F.col("id").alias("t"),
        )
        assert len(check_chunks(df, 500)) >= 6
    with pytest.raises(TypeError):
        ordering.with_ordered_chunks(df.select(F.lit("a").alias("o"), "t"), "o", "t", 5)


def test_missing_order_values_come_first(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("o"), F.col("id").alias("t"))
    rows = ordering.with_ordered_chunks(df, "o", "t", 4).collect()
    assert {r["chunk"] for r in rows if r["o"] is None} == {-1}
    assert all(r["chunk"] >= 0 for r in rows if r["o"] is not None) and len(rows) == 2000


def test_small_tables_stay_in_one_chunk(spark):
    df = spark.range(10).select(F.col("id").alias("o"), F.col("id").alias("t"))
    assert list(check_chunks(df, 500)) == [0]


def test_key_split_is_stable_and_whole(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a1, b1 = sampling.split_by_key(df, "k")
    a2, _ = sampling.split_by_key(df.repartition(13), "k")
    first = {r[0] for r in a1.collect()}
    assert first == {r[0] for r in a2.collect()}
    assert len(first) + b1.count() == 2000
    assert 0.77 < len(first) / 2000 < 0.83
    parts = sampling.random_split(df, 0.8, seed=3)
    assert sum(p.count() for p in parts) == 2000


def test_spreading_keeps_rows(spark):
    df = spark.range(100).coalesce(1)
    assert at_least_partitions(df, 8).rdd.getNumPartitions() == 8
    assert at_least_partitions(df.repartition(6), 8).rdd.getNumPartitions() == 6
    with held(df) as rows:
        assert rows.count() == 100 and rows.storageLevel.useMemory
    assert not rows.storageLevel.useMemory


def test_lookup_join_spreads_a_hot_key(spark, monkeypatch):
    rows = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100)).cast("int").alias("k"), "id")
    table = spark.range(90).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    expected = sorted(map(tuple, rows.join(table, "k").select("k", "id", "v").collect()))
    for limit in (1 << 20, 0):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        got = joins.join_lookup(rows, table, "k", F.col("id"), 16, task_rows=200)
        assert sorted(map(tuple, got.select("k", "id", "v").collect())) == expected
        assert ("_salt" in got._jdf.queryExecution().analyzed().toString()) == (limit == 0)
    assert [tuple(r) for r in joins.hot_keys(rows, "k", 200).collect()] == [(7, 6)]
    assert joins.hot_keys(rows, "k").collect() == []
