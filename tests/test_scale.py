"""Results that must not depend on a table's size, a label's scale or a switch between ways."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomstat.operators import classify, clustering, descent, evaluate, ordering, recommend, sampling, series
from loomstat.sources import read_csv_by_name


def test_tiny_shares_still_draw_rows(spark):
    rows = spark.range(3_000_000)
    seen = [rows.filter(sampling.in_share(5e-6, F.col("id"), F.lit(i))).count() for i in range(3)]
    assert all(3 <= n <= 35 for n in seen), seen
    few = spark.range(10).select("id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    with pytest.raises(ValueError, match="held a row"):
        descent.descend(few, "y", ["x"], descent.hinge, batch_share=1e-12, batch_key="id", num_iterations=3)


@pytest.mark.parametrize("flat", [64, 0])
def test_nearest_center_at_any_scale(spark, monkeypatch, flat):
    monkeypatch.setattr(clustering, "FLAT_CELLS", flat)
    for scale in (1.0, 1e-6, 1e6):
        rows = spark.createDataFrame([(scale, 0.0, 1), (0.0, 0.0, 0), (scale / 2, 0.0, 0)], "x double, y double, want int")
        found = clustering.assign(rows, ["x", "y"], [(0.0, 0.0), (scale, 0.0)]).collect()
        assert [r["cluster"] for r in found] == [r["want"] for r in found]
        assert clustering.cost(rows, ["x", "y"], [(0.0, 0.0)]).first()["cost"] == pytest.approx(1.25 * scale * scale)


def test_a_hundred_wide_centers_are_planned_quickly(spark):
    points = spark.range(200).select("id", F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (F.col("id") * i % 17).cast("double")).alias("v"))
    centers = [[float(k * i % 17) for i in range(1, 65)] for k in range(100)]
    found = {r["id"]: r["cluster"] for r in clustering.assign(points, "v", centers).collect()}
    assert all(found[k] == k % 17 for k in range(100))


@pytest.mark.parametrize("scale", [1.0, 1e-7, 1e5])
def test_root_split_at_any_scale(spark, scale):
    rows = spark.range(16).select(F.col("id").cast("double").alias("x"), F.when(F.col("id") >= 8, scale).otherwise(0.0).alias("y"))
    assert classify.best_root_split(rows, "y", "x", "Variance").first()["threshold"] == 7.5


def test_incomplete_rows_are_left_out_of_every_way(spark):
    cells = [(float(i % 5), None if i % 7 == 0 else i / 10, 1.0 + i % 3) for i in range(60)]
    rows = spark.createDataFrame(cells, "y double, a double, b double")
    same = descent.LinearGradient(descent.least_squares.pull)
    one = descent.descend(rows, "y", ["a", "b"], descent.least_squares, "L2", 0.1, 8, tolerance=0.0)
    two = descent.descend(rows, "y", ["a", "b"], same, "L2", 0.1, 8, tolerance=0.0)
    whole = descent.descend(rows.dropna(), "y", ["a", "b"], same, "L2", 0.1, 8, tolerance=0.0)
    assert one.weights == pytest.approx(two.weights) and two.weights == pytest.approx(whole.weights)


def test_order_columns_are_refused_at_every_size(spark):
    rows = spark.createDataFrame([("s", "a", 1.0), ("s", "b", 2.0)], "s string, o string, v double")
    for chunk_rows in (1, 2_000_000):
        with pytest.raises(TypeError, match="string column"):
            series.series_features(rows, "s", "o", "o", "v", chunk_rows)
    with pytest.raises(TypeError):
        ordering.with_ordered_chunks(rows, "o", None, 1)


def test_missing_points_are_left_out_before_numbering(spark):
    cells = [("s", 0, 0.0), ("s", 1, None), ("s", 2, 2.0), ("s", 3, 4.0), (None, 1, 5.0)]
    rows = spark.createDataFrame(cells, "s string, o int, v double")
    found = series.series_features(rows, "s", "o", "o", "v").collect()
    assert len(found) == 1 and found[0]["n"] == 3 and found[0]["slope"] == pytest.approx(2.0)


def test_short_series_need_one_shuffle_of_the_points(spark):
    rows = spark.range(5000).select((F.col("id") % 50).alias("s"), F.col("id").alias("o"), F.rand(1).alias("v"))
    plan = series.series_features(rows, "s", "o", "o", "v")._jdf.queryExecution().executedPlan().toString()
    points = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert 0 < len(points) <= 3, plan  # the points, and partial sums per series


def test_rows_without_a_score_count_nowhere(spark):
    cells = [(0.9, 1.0), (0.1, 0.0), (None, 1.0), (0.5, None)]
    rows = spark.createDataFrame(cells, "prediction double, label double")
    assert evaluate.binary_areas(rows).first()["auc_roc"] == 1.0
    assert evaluate.threshold_curve(rows).count() == 2


def test_splits_by_several_keys(spark):
    rows = spark.range(4000).select(F.lit(1).alias("hot"), "id")
    one, rest = sampling.split_by_key(rows, ["hot", "id"])
    assert 3000 < one.count() < 3400 and one.count() + rest.count() == 4000


def test_files_with_other_headers_are_refused(spark, tmp_path):
    for name, head in (("a", "x,y"), ("b", "y,x")):
        (tmp_path / f"{name}.csv").write_text(f"{head}\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_by_name(spark, str(tmp_path), ["x", "y"]).collect()


def test_word_bayes_equals_counting_by_hand(spark):
    texts = [(1, "a", "x x y"), (2, "b", "z z y"), (3, "a", "x w"), (4, "b", ""), (5, "c", "q")]
    rows = spark.createDataFrame(texts, "id int, label string, text string")
    each = rows.select("id", "label", F.explode_outer(F.filter(F.split("text", " "), lambda w: w != "")).alias("w"))
    found = {r["id"]: r["prediction"] for r in classify.word_bayes(each, "label", "w", "id").collect()}
    assert found == {1: "a", 2: "b", 3: "a", 4: "a", 5: "c"}


def test_word_bayes_with_a_thousand_classes(spark):
    """Against counting and scoring every class for every text."""
    rng = random.Random(4)
    texts = [(i, f"c{i % 1000:04}", [f"w{rng.randrange(30) + i % 1000 % 40 * 5}" for _ in range(rng.randrange(6))]) for i in range(2100)]
    texts += [(5000, None, ["w3", "new"]), (5001, None, [])]
    rows = spark.createDataFrame(texts, "id int, label string, w array<string>").select("id", "label", F.explode_outer("w").alias("w"))
    found = {r["id"]: r["prediction"] for r in classify.word_bayes(rows, "label", "w", "id").collect()}
    n, words, total = Counter(), Counter(), Counter()
    for _, c, ws in texts:
        if c is not None:
            n[c] += 1
            total[c] += len(ws)
            words.update((c, w) for w in ws)
    v = len({w for _, _, ws in texts for w in ws})
    prior = {c: math.log((n[c] + 1) / (sum(n.values()) + len(n))) for c in n}
    assert len(found) == len(texts)
    for i, _, ws in rng.sample(texts, 150) + texts[-2:]:
        scores = {c: prior[c] + sum(math.log((words[c, w] + 1) / (total[c] + v)) for w in ws) for c in n}
        best = max(scores.values())
        assert found[i] == min(c for c, s in scores.items() if s >= best - abs(best) * 1e-9)


@pytest.mark.parametrize("model_bytes", [0, 6 * 96, 1 << 20])
def test_word_bayes_with_part_of_the_model_at_the_tasks(spark, model_bytes):
    """No word, the six most frequent words or all words are looked up where the texts are read."""
    rng = random.Random(5)
    rows = [(i, rng.choice("abc"), f"w{int(rng.expovariate(0.2))}") for i in range(60) for _ in range(rng.randrange(1, 30))]
    rows = [(i, {0: None}.get(i % 9, "abc"[i % 3]), w) for i, _, w in rows] + [(60, "a", None), (None, "b", "w1"), (None, "b", "w90")]
    each = spark.createDataFrame(rows, "id int, label string, w string").repartition(3)
    texts = {}
    for i, y, w in rows:
        texts.setdefault(i, (y, []))[1].append(w)
    docs = {i: (y, [w for w in ws if w]) for i, (y, ws) in texts.items()}
    labels = sorted({y for y, _ in docs.values() if y})
    words = {w for _, ws in docs.values() for w in ws}
    n = {c: Counter(w for y, ws in docs.values() if y == c for w in ws) for c in labels}
    known = [y for y, _ in docs.values() if y]
    score = {
        (i, c): math.log((known.count(c) + 1) / (len(known) + len(labels)))
        + sum(math.log((n[c][w] + 1) / (n[c].total() + len(words))) for w in ws)
        for i, (_, ws) in docs.items() for c in labels
    }
    found = classify.word_bayes(each, "label", "w", "id", model_bytes=model_bytes).collect()
    assert len(found) == len(docs)
    for row in found:
        if row["id"] is not None:  # a null key meets no scores: prior and length alone decide
            assert score[row["id"], row["prediction"]] == pytest.approx(max(score[row["id"], c] for c in labels))


def test_frequent_words_fit(spark):
    sums = spark.createDataFrame([(float(n),) for n in [1, 1, 1, 2, 3, 4, 9, 17]], "_n double")
    assert [classify._frequent(sums, most) for most in (0, 1, 2, 3, 4, 5, 7, 8)] == [32, 16, 8, 4, 4, 2, 2, 1]


def test_ratings_are_read_once(spark):
    """A fit and its error take several passes over the ratings, which may be a costly join."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    pairs = spark.range(300).selectExpr("cast(id % 30 as int) user", "cast(id / 30 as int) product", "1.0 + id % 5 rating")
    rows = pairs.selectExpr("user", "product", "cast(rating as double) rating")
    model = recommend.fit_als(rows.mapInArrow(count, rows.schema), 2, 2, seed=1)
    assert seen.value == 300
    assert recommend.recommender_rmse(model, rows.mapInArrow(count, rows.schema)).count() == 1
    assert seen.value == 600
