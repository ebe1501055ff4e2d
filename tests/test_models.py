import math

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from loomstat.functions import implicit_confidence
from loomstat.operators import classify, clustering, recommend
from loomstat.operators.features import assemble, from_array
from loomstat.plans import jobs
from loomstat.sources import read_libsvm
from loomstat.sources.files import unpack_vector

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def counts(spark):
    df = spark.range(60).select(
        (F.col("id") % 3).cast("double").alias("label"),
        (F.col("id") % 4).cast("double").alias("a"),
        (F.col("id") * 7 % 5).cast("double").alias("b"),
        (F.col("id") * F.col("id") % 3).cast("double").alias("c"),
        "id",
    )
    zero = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 100)], df.schema)
    return df.unionByName(zero).cache()


def test_naive_bayes_table_equals_the_library(counts):
    table = {r["label"]: r for r in classify.naive_bayes_table(counts, "label", NAMES, 1.0).collect()}
    model = classify.fit_naive_bayes(assemble(counts, NAMES).select("label", "features"), 1.0)
    for i in range(3):
        row = table[float(i)]
        assert row["log_prior"] == pytest.approx(model.pi[i], abs=1e-12)
        assert [row[f"log_{n}"] for n in NAMES] == pytest.approx(model.theta.toArray()[i].tolist(), abs=1e-12)


def test_naive_bayes_prior_is_smoothed_and_counts_must_not_be_negative(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0)], "label int, a double")
    priors = {r["label"]: r["log_prior"] for r in classify.naive_bayes_table(df, "label", ["a"]).collect()}
    assert priors == pytest.approx({0: math.log(0.6), 1: math.log(0.4)})
    with pytest.raises(Exception, match="zero or more"):
        classify.naive_bayes_table(df.withColumn("a", -F.col("a")), "label", ["a"]).collect()


def test_naive_bayes_scores_equal_the_library(counts):
    table = classify.naive_bayes_table(counts, "label", NAMES)
    mine = classify.naive_bayes_score(counts, table, "label", NAMES).select("id", "prediction")
    vectors = assemble(counts, NAMES).select("id", "label", "features")
    library = NaiveBayes().fit(vectors).transform(vectors).select("id", F.col("prediction").alias("p"))
    assert mine.join(library, "id").filter("prediction <> p").count() == 0


@pytest.mark.parametrize("algo,impurity", [("Classification", "Variance"), ("Regression", "Gini"), ("Regression", "Entropy"), ("Other", "Gini")])
def test_tree_parameters_are_checked_first(algo, impurity):
    with pytest.raises(ValueError, match=f"{algo} is not compatible with impurity {impurity}"):
        classify.fit_tree(None, algo, impurity=impurity)


@pytest.mark.parametrize("impurity", ["Gini", "Entropy", "Variance"])
@pytest.mark.parametrize("distinct", [37, 900])
def test_root_split_equals_the_tree(spark, impurity, distinct):
    df = spark.range(900).select(
        (F.col("id") * 31 % distinct).cast("double").alias("x"),
        ((F.col("id") * 31 % distinct > distinct * 0.6) != (F.col("id") % 11 == 0)).cast("double").alias("label"),
    )
    best = classify.best_root_split(df, "label", "x", impurity, 100).first()
    algo = "Regression" if impurity == "Variance" else "Classification"
    model = classify.fit_tree(assemble(df, ["x"]).select("label", "features"), algo, 1, impurity)
    root = model._java_obj.rootNode().split().threshold()
    assert best["threshold"] == pytest.approx(root, abs=0 if distinct < 100 else 12)
    assert best["gain"] > 0


def test_tree_beats_the_majority(spark):
    df = spark.range(500).select(
        "id", (F.col("id") % 50).cast("double").alias("x"), ((F.col("id") % 50) > 20).cast("int").alias("y")
    )
    report = jobs.decision_tree(df, "y", ["x"], "id").first()
    assert report["accuracy"] == 1.0 and report["n_training"] + report["n_test"] == 500
    mse = jobs.decision_tree(df, "y", ["x"], "id", "Regression", impurity="Variance").first()["mse"]
    assert mse == pytest.approx(0.0)


def test_logistic_probabilities(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 20 / 20).alias("x"), ((F.col("id") % 20) > 9).cast("int").alias("y"), F.lit(1.0).alias("one")
    )
    report = jobs.logistic_classification(df, "y", ["x", "one"], "id", reg_param=0.01).first()
    assert report["auc_roc"] == pytest.approx(1.0) and report["auc_pr"] == pytest.approx(1.0)
    with pytest.raises(ValueError, match="NONE"):
        classify.fit_logistic(df, reg_type="NONE")


GROUPS = [(1.0, 1.0), (1.2, 0.9), (0.8, 1.1), (4.0, 4.1), (4.2, 3.9), (1.0, 5.0), (1.1, 4.8)]


def test_kmeans_fit_assign_cost(spark):
    df = spark.createDataFrame(GROUPS, "x double, y double")
    vectors = assemble(df, ["x", "y"]).select("features")
    model = clustering.fit_kmeans(vectors, 3, 10, "Parallel", seed=3)
    centers = [c.tolist() for c in model.clusterCenters()]
    total = clustering.cost(df, ["x", "y"], centers).first()[0]
    assert total == pytest.approx(model.summary.trainingCost, abs=1e-9)
    asked = spark.createDataFrame([(1.0, 1.1), (4.0, 4.0), (1.1, 4.95)], "x double, y double")
    mine = [r["cluster"] for r in clustering.assign(asked, ["x", "y"], centers).collect()]
    library = [r["prediction"] for r in model.transform(assemble(asked, ["x", "y"])).collect()]
    assert mine == library and len(set(mine)) == 3
    with pytest.raises(ValueError, match="Best"):
        clustering.fit_kmeans(vectors, init_mode="Best")


def test_lloyd_steps_and_ties(spark):
    df = spark.createDataFrame(GROUPS, "x double, y double")
    start = [(0.0, 0.0), (5.0, 5.0), (0.0, 5.0)]
    costs = []
    for steps in range(1, 4):
        centers = clustering.lloyd(df, ["x", "y"], start, steps)
        costs.append(clustering.cost(df, ["x", "y"], centers).first()[0])
    assert costs == sorted(costs, reverse=True)
    for got, expected in zip(centers, [(1.0, 1.0), (4.1, 4.0), (1.05, 4.9)]):
        assert got == pytest.approx(expected)
    middle = spark.createDataFrame([(1.0, 0.0)], "x double, y double")
    assert clustering.assign(middle, ["x", "y"], [(2.0, 0.0), (0.0, 0.0)]).first()["cluster"] == 0
    assert clustering.lloyd(middle, ["x", "y"], [(1.0, 0.0), (9.0, 9.0)], 3)[1] == [9.0, 9.0]


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.range(30 * 40).select(
        (F.col("id") % 30).cast("int").alias("user"),
        (F.col("id") / 30).cast("int").alias("product"),
        (1.0 + ((F.col("id") % 30) + (F.col("id") / 30).cast("int")) % 5).alias("rating"),
    ).filter("(user * 7 + product * 3) % 4 <> 0 and product <> 17").cache()


def test_als_beats_the_mean_and_drops_the_unseen(spark, ratings):
    model = recommend.fit_als(ratings, 5, 8, 0.05, seed=2)
    rmse = recommend.recommender_rmse(model, ratings).first()[0]
    assert rmse < ratings.agg(F.stddev_pop("rating")).first()[0]
    asked = spark.createDataFrame([(0, 1), (99, 1), (0, 17)], "user int, product int")
    assert [(r["user"], r["product"]) for r in recommend.score_pairs(model, asked).collect()] == [(0, 1)]
    plain = recommend.score_pairs(model, ratings)
    expected = plain.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2)))).first()[0]
    assert rmse == pytest.approx(expected, abs=1e-6)


def test_repeated_pairs_weigh_their_square(spark, ratings):
    model = recommend.fit_als(ratings, 3, 3, 0.1, seed=2)
    twice = ratings.unionByName(ratings.filter("user = 1"))
    scored = recommend.score_pairs(model, twice.select("user", "product"))
    joined = scored.join(twice, ["user", "product"])
    expected = joined.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2)))).first()[0]
    assert recommend.recommender_rmse(model, twice).first()[0] == pytest.approx(expected, abs=1e-6)


def test_top_items_equal_the_library(spark, ratings):
    model = recommend.fit_als(ratings, 4, 4, 0.1, seed=2)
    mine = recommend.top_items(model, 3, 10).collect()
    users = spark.createDataFrame([(3,)], "user int")
    library = model.recommendForUserSubset(users, 10).first()["recommendations"]
    assert [r["rating"] for r in mine] == pytest.approx([r["rating"] for r in library], abs=1e-5)
    assert recommend.top_items(model, 12345).collect() == []


def test_implicit_recommender_job(ratings):
    data = ratings.withColumn("pair", F.concat_ws(":", "user", "product"))
    data = data.withColumn("rating", implicit_confidence(F.col("rating")))
    profile, rmse, top = jobs.recommender(data, "pair", 3, 3, 0.1, True, user=2, seed=1)
    assert tuple(profile.first()) == (ratings.count(), 30, 39)
    assert 0 <= rmse.first()[0] <= 1 and top.count() == 10


def test_series_job(spark):
    flat = [(i, 0.0, [10.0 + (j * i) % 3 for j in range(64)]) for i in range(60)]
    spiky = [(100 + i, 1.0, [10.0 + (500.0 if j == i % 64 else (j * i) % 3) for j in range(64)]) for i in range(40)]
    df = spark.createDataFrame(flat + spiky, "id int, label double, points array<double>")
    report = jobs.series_anomaly(df, "label", "points", "id").first()
    assert report["n_training"] + report["n_test"] == 100
    assert 0 <= report["accuracy"] <= 100 and 0 <= report["auc_roc"] <= 1


def test_array_to_vector(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert from_array(df, "v").first()["features"].toArray().tolist() == [1.0, 2.0]


def test_jobs_take_libsvm_vectors(spark, tmp_path):
    lines = [f"{int(i % 4 > 1)} 1:{i % 4} 3:{i % 7 + 1}" for i in range(300)]
    path = tmp_path / "rows.txt"
    path.write_text("\n".join(lines))
    rows = read_libsvm(spark, str(path), 3).withColumn("id", F.monotonically_increasing_id())
    named = unpack_vector(rows, "features", NAMES)
    svm = [
        jobs.svm_classification(rows, "label", "features", "id", 10).first(),
        jobs.svm_classification(named, "label", NAMES, "id", 10).first(),
    ]
    assert svm[0] == pytest.approx(svm[1]) and svm[0]["auc_roc"] > 0.9
    bayes = [
        jobs.naive_bayes(rows, "label", "features", "id").first(),
        jobs.naive_bayes(named, "label", NAMES, "id").first(),
    ]
    assert bayes[0] == bayes[1] and bayes[0]["n_training"] + bayes[0]["n_test"] == 300
    line = [
        jobs.linear_regression(rows, "label", "features", "id", 20, 0.05).first(),
        jobs.linear_regression(named, "label", NAMES, "id", 20, 0.05).first(),
    ]
    assert line[0]["weights"] == line[1]["weights"] and line[0]["rmse"] == pytest.approx(line[1]["rmse"])
    tree = jobs.decision_tree(rows, "label", "features", "id").first()
    assert tree["accuracy"] == 1.0
