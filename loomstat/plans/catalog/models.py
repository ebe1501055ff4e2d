"""Model fits and the jobs around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomstat.functions import clip_unit, implicit_confidence, words
from loomstat.operators import classify, clustering, descent, quasi_newton, recommend, trees
from loomstat.operators.features import assemble
from loomstat.operators.partitions import at_least_partitions
from loomstat.operators.sampling import split_by_key
from loomstat.operators.series import FEATURES as SERIES_FEATURES
from loomstat.operators.series import array_features
from loomstat.plans import jobs
from loomstat.plans.catalog import oracle
from loomstat.plans.catalog.base import (
    FEATURES,
    RATINGS_SQL,
    ROWS_SQL,
    in_train_sql,
    query,
    ratings,
    rounded,
    rows,
    table,
)
from loomstat.plans.catalog.series import ARRAY_POINTS_SQL, features_sql
from loomstat.session import scratch_path
from loomstat.sources import read_csv_by_name, read_libsvm


def weights_table(spark: SparkSession, model: descent.Descent) -> DataFrame:
    cells = [(f"w{j}", round(w, 6) + 0.0) for j, w in enumerate(model.weights)]
    return spark.createDataFrame(cells, "term string, weight double")


def _linear(name: str, reg_type: str) -> None:
    steps = oracle.Steps(ROWS_SQL, "price", FEATURES, "least_squares", reg_type, 1.0, 0.1, 20)

    @query(name, steps.weights())
    def fit(spark, folder):
        model = descent.linear_regression(
            rows(spark, folder), "price", FEATURES, 20, 1.0, reg_type, 0.1, tolerance=0.0
        )
        return weights_table(spark, model)


for _reg in ("NONE", "L1", "L2"):
    _linear(f"linreg_sgd_{_reg.lower()}", _reg)


@query(
    "svm_sgd_l1",
    oracle.Steps(ROWS_SQL, "flag", FEATURES, "hinge", "L1", 1.0, 0.02, 20).weights(),
)
def svm_sgd_l1(spark, folder):
    model = descent.linear_svm(
        rows(spark, folder), "flag", FEATURES, 20, 1.0, "L1", 0.02, tolerance=0.0
    )
    return weights_table(spark, model)


@query("linreg_hundred_steps", oracle.Steps(ROWS_SQL, "price", FEATURES, "least_squares", "L2", 1.0, 0.1, 100).weights())
def linreg_hundred_steps(spark, folder):
    """As many steps as the jobs take by default, none left out by an early stop."""
    model = descent.linear_regression(rows(spark, folder), "price", FEATURES, 100, tolerance=0.0)
    return weights_table(spark, model)


EDGE = 0.2


def huber(label, features, weights):
    """A caller's own gradient: squared error near the line, and beyond ``EDGE`` a pull of fixed size."""
    error = descent.dot(features, weights) - label
    pull = F.greatest(F.lit(-EDGE), F.least(F.lit(EDGE), error))
    far = F.lit(EDGE) * (F.abs(error) - F.lit(EDGE / 2))
    return [pull * x for x in features], F.when(F.abs(error) <= EDGE, error * error / 2).otherwise(far)


_CUSTOM = oracle.Steps(
    f"SELECT 1.0::DOUBLE AS x0, x0 AS x1, price FROM ({ROWS_SQL})",
    "price", ["x0", "x1"], "huber", "NONE", 1.0, 0.1, 15, tolerance=0.001, edge=EDGE,
)


def _custom(spark, folder) -> descent.Descent:
    data = rows(spark, folder).select(F.lit(1.0).alias("x0"), F.col("x0").alias("x1"), "price")
    return descent.descend(
        data, "price", ["x0", "x1"], huber, "NONE", 1.0, 15, 0.1
    )


@query("custom_gradient_gd", _CUSTOM.weights())
def custom_gradient_gd(spark, folder):
    return weights_table(spark, _custom(spark, folder))


_LOSSES = oracle.Steps(ROWS_SQL, "flag", FEATURES, "hinge", "L2", 0.5, 0.1, 15)


@query("gd_loss_history", _LOSSES.losses())
def gd_loss_history(spark, folder):
    model = descent.descend(
        rows(spark, folder), "flag", FEATURES, descent.hinge, "L2", 0.5, 15, 0.1, tolerance=0.0
    )
    cells = [(i, round(loss, 6)) for i, loss in enumerate(model.losses, start=1)]
    return spark.createDataFrame(cells, "iteration int, loss double")


_BATCHES = oracle.Steps(
    "SELECT p_partkey, p_size / 50.0::DOUBLE AS x0, 1.0::DOUBLE AS x1, ln(p_retailprice + 1) AS label FROM part",
    "label", ["x0", "x1"], "least_squares", "L2", 0.5, 0.01, 10, batch_key="p_partkey", batch_share=0.5,
)


@query("gd_minibatch", _BATCHES.weights())
def gd_minibatch(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey",
        (F.col("p_size") / F.lit(50.0)).alias("x0"),
        F.lit(1.0).alias("x1"),
        F.log1p("p_retailprice").alias("label"),
    )
    model = descent.descend(
        parts, "label", ["x0", "x1"], descent.least_squares, "L2", 0.5, 10, 0.01,
        batch_share=0.5, batch_key="p_partkey", tolerance=0.0,
    )
    return weights_table(spark, model)


def _logistic(name: str, reg_type: str, reg_param: float) -> None:
    @query(name, oracle.logistic_sql(ROWS_SQL, "flag", FEATURES, reg_type, reg_param, 400))
    def fit(spark, folder):
        data = rows(spark, folder).withColumnRenamed("flag", "label")
        vectors = assemble(data, FEATURES).select("label", "features")
        model = classify.fit_logistic(vectors, 500, reg_type, reg_param, False, 1e-12)
        cells = [(f"w{j}", round(float(w), 4) + 0.0) for j, w in enumerate(model.coefficients)]
        return spark.createDataFrame(cells, "term string, weight double")


def _quasi_newton(name: str, reg_type: str, reg_param: float) -> None:
    @query(name, oracle.logistic_sql(ROWS_SQL, "flag", FEATURES, reg_type, reg_param, 400))
    def fit(spark, folder):
        model = quasi_newton.fit(
            rows(spark, folder), "flag", FEATURES, descent.log_loss, reg_type, reg_param, tolerance=1e-9
        )
        cells = [(f"w{j}", round(w, 4) + 0.0) for j, w in enumerate(model.weights)]
        return spark.createDataFrame(cells, "term string, weight double")


_quasi_newton("quasi_newton_l2", "L2", 0.1)
_quasi_newton("quasi_newton_l1", "L1", 0.01)
_logistic("logreg_l2", "L2", 0.1)
_logistic("logreg_l1", "L1", 0.01)


# The counted words.
VOCABULARY = ["the", "of", "and", "to", "in", "a"]
COUNTS = [f"n_{w}" for w in VOCABULARY]
COUNTS_SQL = "SELECT doc_id, quality AS label, {} FROM documents JOIN labels USING (doc_id)".format(
    ", ".join(
        rf"len(list_filter(string_split_regex(text, '[ \r\n]'), lambda w: w = '{v}'))::DOUBLE AS n_{v}"
        for v in VOCABULARY
    )
)


def _documents(spark, folder) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    documents = at_least_partitions(table(spark, folder, "documents").select("doc_id", "text"))
    labelled = documents.join(labels, "doc_id")
    return jobs.word_features(labelled, "text", VOCABULARY, ["doc_id", "label"])


@query("naive_bayes_model", oracle.naive_bayes_model_sql(COUNTS_SQL, COUNTS))
def naive_bayes_model(spark, folder):
    model = classify.naive_bayes_table(_documents(spark, folder), "label", COUNTS)
    logs = ["log_prior", *[f"log_{c}" for c in COUNTS]]
    return model.select("label", *[rounded(c).alias(c) for c in logs])


@query("naive_bayes_predict", oracle.naive_bayes_predict_sql(COUNTS_SQL, COUNTS))
def naive_bayes_predict(spark, folder):
    documents = _documents(spark, folder)
    model = classify.naive_bayes_table(documents, "label", COUNTS)
    scored = classify.naive_bayes_score(documents, model, "label", COUNTS)
    return scored.select("doc_id", "label", "prediction")


@query("naive_bayes_accuracy", oracle.naive_bayes_accuracy_sql(COUNTS_SQL, COUNTS, in_train_sql("doc_id")))
def naive_bayes_accuracy(spark, folder):
    report = jobs.naive_bayes(_documents(spark, folder), "label", COUNTS, "doc_id")
    return report.withColumn("accuracy", rounded("accuracy"))


@query(
    "naive_bayes_words",
    r"""WITH t AS (SELECT doc_id, lang, unnest(string_split_regex(text, '[ \r\n]')) AS w FROM documents),
        c AS (SELECT lang, w, count(*) AS n FROM t WHERE w <> '' GROUP BY ALL),
        s AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
        v AS (SELECT count(DISTINCT w) AS v FROM c),
        p AS (SELECT lang, ln((count(*) + 1) / (sum(count(*)) OVER () + count(*) OVER ())) AS prior
              FROM documents GROUP BY lang),
        d AS (SELECT doc_id, w, count(*) AS tf FROM t WHERE w <> '' GROUP BY ALL),
        l AS (SELECT d.doc_id, s.lang, sum(tf * ln((coalesce(n, 0) + 1) / (total + v))) AS l
              FROM d JOIN s ON true CROSS JOIN v LEFT JOIN c ON c.lang = s.lang AND c.w = d.w GROUP BY ALL),
        q AS (SELECT documents.doc_id, p.lang, prior + coalesce(l, 0) AS score
              FROM documents JOIN p ON true LEFT JOIN l ON l.doc_id = documents.doc_id
              WHERE l.lang = p.lang OR l.lang IS NULL),
        b AS (SELECT *, max(score) OVER (PARTITION BY doc_id) AS best FROM q)
        SELECT doc_id, min(lang) AS prediction FROM b WHERE score >= best - abs(best) * 1e-9 GROUP BY doc_id""",
)
def naive_bayes_words(spark, folder):
    """Language of every document from all its words, four classes and the whole vocabulary."""
    documents = at_least_partitions(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    each = documents.select("doc_id", "lang", F.explode_outer(F.filter(words("text"), lambda w: w != "")).alias("word"))
    return classify.word_bayes(each, "lang", "word", "doc_id")


LIBSVM_SQL = f"SELECT flag, x0 AS x0, x1 AS x1, x2 AS x2, price FROM ({ROWS_SQL})"


def _libsvm(spark, folder, label: str) -> DataFrame:
    """The rows as LIBSVM files, zeros left out, read back without a given width."""
    path = scratch_path(spark, "wide")
    vectors = assemble(rows(spark, folder), FEATURES).select(F.col(label).alias("label"), "features")
    vectors.write.format("libsvm").save(path)
    return read_libsvm(spark, path)


@query("libsvm_svm", oracle.Steps(LIBSVM_SQL, "flag", FEATURES, "hinge", "L1", 1.0, 0.02, 10).weights())
def libsvm_svm(spark, folder):
    model = descent.linear_svm(_libsvm(spark, folder, "flag"), "label", "features", 10, 1.0, "L1", 0.02, tolerance=0.0)
    return weights_table(spark, model)


@query("libsvm_linear", oracle.Steps(LIBSVM_SQL, "price", FEATURES, "least_squares", "L2", 1.0, 0.1, 10).weights())
def libsvm_linear(spark, folder):
    model = descent.linear_regression(_libsvm(spark, folder, "price"), "label", "features", 10, tolerance=0.0)
    return weights_table(spark, model)


@query("libsvm_bayes", oracle.naive_bayes_model_sql(f"SELECT flag AS label, x0, x1, x2 FROM ({ROWS_SQL})", FEATURES))
def libsvm_bayes(spark, folder):
    model = classify.fit_naive_bayes(_libsvm(spark, folder, "flag"))
    cells = [
        (float(i), *[round(float(v), 6) for v in (model.pi[i], *model.theta.toArray()[i])])
        for i in range(model.numClasses)
    ]
    names = ["log_prior", *[f"log_{f}" for f in FEATURES]]
    return spark.createDataFrame(cells, ["label", *names])


TEN = [f"y{j}" for j in range(10)]
_TEN_SQL = f"SELECT price, {', '.join(f'x{j % 3} * {j + 1}::DOUBLE / 10 AS y{j}' for j in range(10))} FROM ({ROWS_SQL})"
_POINTS = oracle.Steps(_TEN_SQL, "price", TEN, "least_squares", "L2", 0.1, 0.1, 20)


@query(
    "score_literal_points",
    f"""{_POINTS.recursion()}, last AS (SELECT * FROM w ORDER BY i DESC LIMIT 1)
        SELECT 0 AS point, round({' + '.join(f'{j + 1}::DOUBLE * w{j}' for j in range(10))}, 5) AS prediction FROM last
        UNION ALL SELECT 1, round({' + '.join(f'3::DOUBLE * w{j}' for j in range(10))}, 5) FROM last""",
)
def score_literal_points(spark, folder):
    """A model of ten features from the table's rows, applied to the points 1..10 and ten 3s."""
    wide = rows(spark, folder).select(
        "price", *[(F.col(f"x{j % 3}") * float(j + 1) / 10).alias(f"y{j}") for j in range(10)]
    )
    model = descent.linear_regression(wide, "price", TEN, 20, 0.1, tolerance=0.0)
    cells = [(0, *map(float, range(1, 11))), (1, *[3.0] * 10)]
    points = spark.createDataFrame(cells, ["point", *TEN]).withColumn("point", F.col("point").cast("int"))
    return points.select("point", rounded(descent.margin(TEN, model.weights), 5).alias("prediction"))


TREE_SQL = """
    SELECT p_partkey, p_size::DOUBLE AS x,
           CASE WHEN p_brand IN ('Brand#1', 'Brand#3', 'Brand#5', 'Brand#7', 'Brand#11', 'Brand#13')
                THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag,
           p_retailprice AS price
    FROM part
"""
TREE_BRANDS = ["Brand#1", "Brand#3", "Brand#5", "Brand#7", "Brand#11", "Brand#13"]


def _parts(spark, folder) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_size").cast("double").alias("x"),
        F.when(F.col("p_brand").isin(TREE_BRANDS), 1.0).otherwise(0.0).alias("flag"),
        F.col("p_retailprice").alias("price"),
    )


def _root(impurity: str, label: str) -> None:
    @query(f"tree_root_split_{impurity.lower()}", oracle.root_split_sql(TREE_SQL, label, impurity))
    def split(spark, folder):
        best = classify.best_root_split(_parts(spark, folder), label, "x", impurity)
        return best.select("threshold", rounded("gain").alias("gain"))


_root("Gini", "flag")
_root("Entropy", "flag")
_root("Variance", "price")


def _tree(name: str, algo: str, impurity: str, label: str, depth: int) -> None:
    @query(name, oracle.tree_sql(TREE_SQL, label, impurity, depth))
    def fit(spark, folder):
        parts = _parts(spark, folder).withColumnRenamed(label, "label")
        vectors = assemble(parts, ["x"]).select("p_partkey", "label", "features")
        model = classify.fit_tree(vectors, algo, depth, impurity)
        return model.transform(vectors).select("p_partkey", rounded("prediction").alias("prediction"))


_tree("tree_classify", "Classification", "Gini", "flag", 3)
_tree("tree_classify_entropy", "Classification", "Entropy", "flag", 3)
_tree("tree_regress", "Regression", "Variance", "price", 3)


def _tree_job(name: str, label: str, algo: str, impurity: str, measure: str) -> None:
    depth = 4

    @query(name, oracle.tree_holdout_sql(ROWS_SQL, label, FEATURES, impurity, depth, in_train_sql("l_orderkey"), measure))
    def fit(spark, folder):
        lines = rows(spark, folder)
        report = jobs.decision_tree(lines, label, FEATURES, "l_orderkey", algo, depth, impurity)
        return report.withColumn(measure, rounded(measure))


_tree_job("tree_holdout", "flag", "Classification", "Gini", "accuracy")
_tree_job("tree_holdout_entropy", "flag", "Classification", "Entropy", "accuracy")
_tree_job("tree_holdout_regression", "price", "Regression", "Variance", "mse")


CLASSES_SQL = """
    SELECT l_quantity / 50 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2,
           CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y
    FROM lineitem
"""
_MODE = "CASE WHEN s0 >= greatest(s1, s2) THEN 0.0::DOUBLE WHEN s1 >= s2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END"


def _classes(spark, folder) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    label = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    return lines.select(
        (F.col("l_quantity") / 50).alias("x0"), (F.col("l_discount") * 10).alias("x1"), (F.col("l_tax") * 10).alias("x2"), label.alias("y")
    )


def _nodes(spark, tree) -> DataFrame:
    found = trees.node_table(spark, tree)
    return found.select("node", "feature", *[rounded(c).alias(c) for c in ("threshold", "gain")], "n", rounded("prediction").alias("prediction"))


def _tree_nodes(name: str, impurity: str, depth: int) -> None:
    counts = [f"count(*) FILTER (y = {c})::DOUBLE" for c in range(3)]

    @query(name, oracle.tree_nodes_sql(CLASSES_SQL, counts, _MODE, FEATURES, impurity, depth))
    def nodes(spark, folder):
        """Every node of a tree over three features and three classes."""
        return _nodes(spark, trees.grow(_classes(spark, folder), "y", FEATURES, "Classification", depth, impurity))


_tree_nodes("tree_nodes", "Gini", 3)
_tree_nodes("tree_nodes_entropy", "Entropy", 2)
_tree_nodes("tree_nodes_deep", "Gini", 5)  # the default depth of the jobs


@query(
    "tree_nodes_regression",
    oracle.tree_nodes_sql(
        ROWS_SQL, ["count(*)::DOUBLE", "sum(price)::DOUBLE", "sum(price * price)::DOUBLE"], "s1 / s0", FEATURES, "Variance", 3
    ),
)
def tree_nodes_regression(spark, folder):
    """Every node of a regression tree over three features."""
    return _nodes(spark, trees.grow(rows(spark, folder), "price", FEATURES, "Regression", 3, "Variance"))


START = [(0.1, 0.1), (0.5, 0.5), (0.9, 0.9)]


@query("kmeans_lloyd", oracle.lloyd_sql(f"SELECT x0 AS x, x1 AS y FROM ({ROWS_SQL})", START, 5))
def kmeans_lloyd(spark, folder):
    points = rows(spark, folder).select(F.col("x0").alias("x"), F.col("x1").alias("y"))
    centers = clustering.lloyd(points, ["x", "y"], START, 5)
    cells = [(i, round(x, 6), round(y, 6)) for i, (x, y) in enumerate(centers)]
    return spark.createDataFrame(cells, "cluster int, x double, y double")


def _kmeans(name: str, init_mode: str) -> None:
    @query(name, "SELECT count(*) AS n, 3::BIGINT AS clusters, true AS below_one_center FROM lineitem")
    def fit(spark, folder):
        """A fit from a random start: rows and clusters it covers, and that it beats a single center."""
        lines = rows(spark, folder).select("x0", "x1")
        model = clustering.fit_kmeans(assemble(lines, ["x0", "x1"]).select("features"), 3, 10, init_mode, seed=7)
        centers = [[float(v) for v in c] for c in model.clusterCenters()]
        found = clustering.assign(lines, ["x0", "x1"], centers)
        one = F.var_pop("x0") + F.var_pop("x1")
        own = clustering.cost(lines, ["x0", "x1"], centers).first()["cost"]
        return found.agg(
            F.count("*").alias("n"),
            F.count_distinct("cluster").alias("clusters"),
            (F.lit(own) < F.count("*") * one).alias("below_one_center"),
        )


_kmeans("kmeans_fit", "Parallel")
_kmeans("kmeans_random", "Random")


_PARTS_SQL = "SELECT p_partkey AS k, p_size / 50.0::DOUBLE AS x, p_retailprice / 2000 AS y FROM part"


@query("kmeans_seeds", oracle.seeds_sql(_PARTS_SQL, 4, 3, 8.0))
def kmeans_seeds(spark, folder):
    """Four starting centers by oversampling."""
    points = table(spark, folder, "part").select(
        "p_partkey", (F.col("p_size") / F.lit(50.0)).alias("x"), (F.col("p_retailprice") / 2000).alias("y")
    )
    seeds = clustering.oversampled_seeds(points, ["x", "y"], "p_partkey", 4, 3)
    cells = [(i, round(x, 6), round(y, 6)) for i, (x, y) in enumerate(seeds)]
    return spark.createDataFrame(cells, "cluster int, x double, y double")


def _als(spark, folder, implicit: bool):
    data = ratings(spark, folder)
    if implicit:
        data = data.withColumn("rating", implicit_confidence(F.col("rating")))
    training, test = split_by_key(data.withColumn("pair", F.concat_ws(":", "user", "product")), "pair")
    model = recommend.fit_als(training, 5, 5, 0.1, implicit, seed=7)
    return model, test


_IN_TRAIN = in_train_sql("concat(user_id, ':', product_id)")
_SPLIT_SQL = f"""
    WITH r AS (SELECT *, {_IN_TRAIN} AS training FROM ({RATINGS_SQL})),
    known AS (SELECT DISTINCT user_id, product_id FROM r WHERE NOT training
              AND user_id IN (SELECT user_id FROM r WHERE training)
              AND product_id IN (SELECT product_id FROM r WHERE training))
"""


@query("als_explicit", f"{_SPLIT_SQL} SELECT user_id AS user, product_id AS product, true AS in_range FROM known")
def als_explicit(spark, folder):
    """The held-out pairs that the model can score: those whose user and product it has seen."""
    model, test = _als(spark, folder, False)
    scored = recommend.score_pairs(model, test.select("user", "product").distinct())
    near = F.col("prediction").between(-5, 15)
    return scored.select("user", "product", near.alias("in_range"))


@query("als_implicit", f"{_SPLIT_SQL} SELECT count(*) AS pairs, true AS in_unit, true AS finite FROM known")
def als_implicit(spark, folder):
    """An implicit fit: pairs it scores, and that clipped scores and their error lie in [0, 1]."""
    model, test = _als(spark, folder, True)
    rmse = recommend.recommender_rmse(model, test, True).first()["rmse"]
    scored = recommend.score_pairs(model, test.select("user", "product").distinct())
    clipped = clip_unit(F.col("prediction"))
    return scored.agg(
        F.count("*").alias("pairs"),
        F.min(clipped.between(0, 1)).alias("in_unit"),
        F.lit(0 <= rmse <= 1).alias("finite"),
    )


@query(
    "recommend_top10",
    f"""{_SPLIT_SQL} SELECT k AS place, true AS known, true AS falling, true AS new
        FROM (SELECT unnest(range(1, 11)) AS k)""",
)
def recommend_top10(spark, folder):
    """Ten different known products, ratings falling."""
    model, _ = _als(spark, folder, False)
    user = model.userFactors.agg(F.min("id")).first()[0]
    order = Window.orderBy(F.col("rating").desc(), F.col("product"))  # ten rows
    top = recommend.top_items(model, user, 10).select("product", "rating", F.row_number().over(order).alias("place"))
    items = model.itemFactors.select(F.col("id").alias("product"), F.lit(True).alias("known"))
    fall = F.coalesce(F.lag("rating").over(order) >= F.col("rating"), F.lit(True))
    seen = F.count("*").over(Window.partitionBy("product"))
    return top.join(items, "product", "left").select(
        F.col("place").cast("long").alias("place"),
        F.coalesce("known", F.lit(False)).alias("known"),
        fall.alias("falling"),
        (seen == 1).alias("new"),
    )


@query("recommender_default")
def recommender_default(spark, folder):
    """Ten best products of the first user after the jobs' default fit: rank ten, twenty iterations."""
    data = ratings(spark, folder).withColumn("pair", F.concat_ws(":", "user", "product"))
    user = data.agg(F.min("user")).first()[0]
    _, _, top = jobs.recommender(data, "pair", user=user, seed=7)
    order = Window.orderBy(F.col("rating").desc(), "product")  # ten rows
    return top.select(F.row_number().over(order).cast("long").alias("place"), "product", rounded("rating", 3).alias("rating"))


@query(
    "recommender_job",
    f"""{_SPLIT_SQL}, p AS (SELECT count(*) AS ratings, count(DISTINCT user_id) AS users,
                                   count(DISTINCT product_id) AS products FROM r)
        SELECT ratings, users, products, true AS below_spread, 10::BIGINT AS recommended FROM p""",
)
def recommender_job(spark, folder):
    """Profile, explicit fit, held-out error below the ratings' range, ten items for a user."""
    data = ratings(spark, folder).withColumn("pair", F.concat_ws(":", "user", "product"))
    user = data.agg(F.min("user")).first()[0]
    profile, error, top = jobs.recommender(data, "pair", 5, 5, 0.1, user=user, seed=7)
    rmse, best = error.first()["rmse"], top.count()
    named = profile.toDF(*["ratings", "users", "products"])
    return named.select("*", F.lit(rmse < 4.0).alias("below_spread"), F.lit(best).cast("long").alias("recommended"))


SALES_SQL = f"""
    SELECT l_orderkey, ln(l_extendedprice + 1) AS label,
           CASE WHEN l_returnflag = 'N' THEN 40.0::DOUBLE ELSE l_quantity END AS x0, l_discount * 100 AS x1
    FROM lineitem
"""


@query("sales_regression", oracle.holdout_regression_sql(SALES_SQL, "label", ["x0", "x1"], in_train_sql("l_orderkey")))
def sales_regression(spark, folder):
    cells = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_extendedprice").cast("string").alias("price_doc"),
        F.when(F.col("l_returnflag") == "N", "NA").otherwise(F.col("l_quantity").cast("string")).alias("full_sq"),
        (F.col("l_discount") * 100).cast("string").alias("life_sq"),
    )
    report = jobs.sales_regression(cells, "l_orderkey")
    return report.withColumn("rmse", rounded("rmse"))


@query("sales_csv", oracle.holdout_regression_sql(SALES_SQL, "label", ["x0", "x1"], in_train_sql("l_orderkey")))
def sales_csv(spark, folder):
    """The sales job from a CSV file with more columns than it uses."""
    path = scratch_path(spark, "sales")
    table(spark, folder, "lineitem").select(
        "l_linestatus",
        F.when(F.col("l_returnflag") == "N", "NA").otherwise(F.col("l_quantity").cast("string")).alias("full_sq"),
        F.col("l_extendedprice").alias("price_doc"),
        (F.col("l_discount") * 100).alias("life_sq"),
        "l_orderkey",
    ).write.option("header", True).csv(path)
    cells = read_csv_by_name(spark, path, ["l_orderkey", "price_doc", "full_sq", "life_sq"])
    report = jobs.sales_regression(cells, "l_orderkey")
    return report.withColumn("rmse", rounded("rmse"))


@query(
    "svm_classification",
    oracle.holdout_svm_sql(
        f"SELECT l_orderkey AS k, flag AS y, x0, x1, x2 FROM ({ROWS_SQL})", FEATURES, in_train_sql("k"), 20, 1.0, 0.02
    ),
)
def svm_classification(spark, folder):
    report = jobs.svm_classification(
        rows(spark, folder), "flag", FEATURES, "l_orderkey", num_iterations=20, reg_param=0.02
    )
    return report.select(
        "n_training", "n_test", *[rounded(c).alias(c) for c in ("accuracy", "auc_roc", "auc_pr")]
    )


SERIES_SQL = f"""
    SELECT f.vec_id AS k, CASE WHEN e.label < 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y,
           ybar AS x0, stdev AS x1, slope AS x2, largest_delta AS x3,
           one_sigma::DOUBLE AS x4, two_sigma::DOUBLE AS x5, three_sigma::DOUBLE AS x6
    FROM ({features_sql(ARRAY_POINTS_SQL, "vec_id", None)}) f JOIN embeddings e ON e.vec_id = f.vec_id
"""


SERIES_X = [f"x{j}" for j in range(7)]


def _series(spark, folder) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    flag = F.when(F.col("label") < 5, 1.0).otherwise(0.0)
    return vectors.select("vec_id", flag.alias("label"), "embedding")


@query(
    "ts_svm",
    oracle.Steps(
        SERIES_SQL, "y", SERIES_X, "hinge", "L1", 1.0, 0.1, 20
    ).weights(),
)
def ts_svm(spark, folder):
    featured = array_features(_series(spark, folder), "embedding", ["vec_id", "label"])
    model = descent.linear_svm(featured, "label", SERIES_FEATURES, 20, 1.0, tolerance=0.0)
    return weights_table(spark, model)


@query("series_anomaly", oracle.holdout_svm_sql(SERIES_SQL, SERIES_X, in_train_sql("k"), 20, 1.0, 0.1))
def series_anomaly(spark, folder):
    report = jobs.series_anomaly(_series(spark, folder), "label", "embedding", "vec_id", num_iterations=20)
    return report.select(
        "n_training", "n_test", *[rounded(c).alias(c) for c in ("accuracy", "auc_roc", "auc_pr")]
    )


@query(
    "logistic_classification",
    oracle.holdout_logistic_sql(
        f"SELECT l_orderkey AS k, flag AS y, x0, x1, x2 FROM ({ROWS_SQL})", FEATURES, in_train_sql("k"), 0.02, 400
    ),
)
def logistic_classification(spark, folder):
    report = jobs.logistic_classification(
        rows(spark, folder), "flag", FEATURES, "l_orderkey", reg_param=0.02, standardization=False, tolerance=1e-12
    )
    return report.select("n_training", "n_test", *[rounded(c).alias(c) for c in ("auc_roc", "auc_pr")])
