"""Logistic regression, naive Bayes and decision trees."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomstat.functions import doubles
from loomstat.operators.joins import BROADCAST_BYTES
from loomstat.operators.partitions import held
from loomstat.session import written

CLASS_IMPURITIES = ("Gini", "Entropy")
VALUE_IMPURITIES = ("Variance",)
# Scores this near to the best, relative to its size, count as equal to it.
NEAR = 1e-9


def fit_logistic(
    rows: DataFrame,
    num_iterations: int = 100,
    reg_type: str = "L2",
    reg_param: float = 0.1,
    standardization: bool = True,
    tolerance: float = 1e-6,
):
    """Binary logistic regression by L-BFGS without intercept; ``reg_type`` is L1 or L2."""
    if reg_type not in ("L1", "L2"):
        raise ValueError(f"unknown reg_type {reg_type}: use L1 or L2")
    model = LogisticRegression(
        maxIter=num_iterations,
        regParam=reg_param,
        elasticNetParam=1.0 if reg_type == "L1" else 0.0,
        fitIntercept=False,
        standardization=standardization,
        tol=tolerance,
    )
    with held(rows) as data:
        return model.fit(data)


def probability_of_one(model, rows: DataFrame, name: str = "prediction") -> DataFrame:
    """Score rows with the probability of class 1 in place of a class."""
    scored = model.transform(rows).drop("prediction", "rawPrediction")
    return scored.withColumn(name, F.get(vector_to_array("probability"), 1)).drop("probability")


def fit_naive_bayes(rows: DataFrame, smoothing: float = 1.0):
    """Multinomial naive Bayes on a vector column."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial").fit(rows)


def naive_bayes_table(
    rows: DataFrame, label: str, features: Sequence[str], smoothing: float = 1.0
) -> DataFrame:
    """The same model as a table: ``label, log_prior, log_<feature>...``, one row per class.

    Both the class weights and the feature weights are smoothed. One grouped pass; the windows run
    over one row per class.
    """
    bad = F.raise_error(F.lit("naive Bayes needs feature counts of zero or more"))
    counts = [F.when(F.col(f) >= 0, F.col(f).cast("double")).otherwise(bad.cast("double")) for f in features]
    grouped = rows.groupBy(label).agg(
        F.count("*").cast("double").alias("_n"),
        *[F.sum(c).alias(f) for c, f in zip(counts, features)],
    )
    every = Window.partitionBy()
    total = sum((F.col(f) for f in features[1:]), F.col(features[0]))
    lam = F.lit(float(smoothing))
    classes = F.count("*").over(every)
    return grouped.select(
        label,
        F.log((F.col("_n") + lam) / (F.sum("_n").over(every) + lam * classes)).alias("log_prior"),
        *[
            F.log((F.col(f) + lam) / (total + lam * len(features))).alias(f"log_{f}")
            for f in features
        ],
    )


def naive_bayes_score(rows: DataFrame, table: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Add the most likely class as ``prediction``; among scores within a billionth of the best
    one's size the smallest label wins.

    The model table has one row per class, so it is fetched and applied as constants.
    """
    model = sorted(table.collect(), key=lambda row: row[label])
    scores = []
    for row in model:
        score = F.lit(row["log_prior"])
        for f in features:
            score = score + F.col(f) * F.lit(row[f"log_{f}"])
        scores.append(score)
    return rows.withColumn("prediction", _first_near_best(scores, [F.lit(row[label]) for row in model]))


def _first_near_best(scores: Sequence[Column], labels: Sequence[Column]) -> Column:
    """The first label whose score lies within a billionth of the best score's size."""
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    near = best - F.abs(best) * NEAR
    chosen = F.when(scores[0] >= near, labels[0])
    for score, label in zip(scores[1:], labels[1:]):
        chosen = chosen.when(score >= near, label)
    return chosen


def _frequent(sums: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` of the sums ``_n`` reach; one row per power is fetched."""
    power = F.floor(F.log2("_n")).cast("int").alias("p")
    found = {r["p"]: r["c"] for r in sums.groupBy(power).agg(F.count("*").alias("c")).collect()}
    least = max(found, default=0) + 1
    while least > 0 and found.get(least - 1, 0) <= most:
        least -= 1
        most -= found.get(least, 0)
    return 1 << least


def word_bayes(
    words: DataFrame, label: str, word: str, key: str, smoothing: float = 1.0, model_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Multinomial naive Bayes over whole texts and their whole vocabulary: ``key, prediction``.

    ``words`` has one row per word of a text, with the text's key and label; a null word stands for a
    text without words, a text without a label is predicted but not learned from.

    The model is long: for each word, the classes that hold it and how far its log weight there lies
    above that of an absent word. A text's score under a class is the class's prior, plus the weight of
    as many absent words as the text is long, plus these differences, which are never negative. So
    the best class is the better one of two: the best of those that share a word with the text, found
    among (text, class) rows, and the best by prior and length alone, found from one number per class.
    No class is a column, and there may be as many as fit into one array. Ties are broken as in
    ``naive_bayes_score``: the smallest label within a billionth of the best score.

    The most frequent words, as many as ``model_bytes`` hold, are sent to every task, so their differences are
    added up where the texts are read. Only the other words, which have few occurrences each, are shuffled to
    the rest of the model. What several passes need is written to the shared folder.
    """
    if smoothing <= 0:
        raise ValueError("word_bayes needs a smoothing above zero")
    # by label too, as a first string cannot be kept in a hash table and would have every word sorted
    lengths = words.groupBy(key, label).agg(F.count(word).cast("double").alias("_length"))
    lengths = lengths.groupBy(key).agg(F.first(label).alias(label), F.sum("_length").alias("_length"))
    texts = written(lengths, "bayes-texts")
    sizes = {r[0]: r[1] for r in texts.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*")).collect()}
    labels = sorted(sizes)
    kind = words.schema[label].dataType
    if not labels:
        return texts.select(key, F.lit(None).cast(kind).alias("prediction"))
    named = words.filter(F.col(word).isNotNull())
    number = F.broadcast(words.sparkSession.createDataFrame(list(enumerate(labels)), f"_c int, {label} {kind.simpleString()}"))
    counted = named.join(number, label, "left").groupBy(word, "_c").agg(F.count("*").cast("double").alias("_n"))
    counted = written(counted, "bayes-counts")
    counts = counted.filter(F.col("_c").isNotNull())
    totals = {r["_c"]: r["n"] for r in counts.groupBy("_c").agg(F.sum("_n").alias("n")).collect()}
    vocabulary = counted.select(word).distinct().count()
    lam = float(smoothing)
    every = sum(sizes.values()) + lam * len(labels)
    prior = [math.log((sizes[c] + lam) / every) for c in labels]
    mass = [totals.get(i, 0.0) + lam * vocabulary for i in range(len(labels))]
    absent = [math.log(lam / m) if m else 0.0 for m in mass]
    gain = F.log((F.col("_n") + lam) / F.lit(lam)).alias("gain")
    model = counts.groupBy(word).agg(F.collect_list(F.struct("_c", gain)).alias("_classes"), F.sum("_n").alias("_n"))
    model = written(model, "bayes-model")
    least = _frequent(model, model_bytes // (16 * min(len(labels), 64) + 64))
    frequent = F.broadcast(model.filter(F.col("_n") >= least).drop("_n"))
    met = named.select(key, word).join(frequent, word).select(key, "_classes")
    if least > 1:
        others = named.select(key, word).join(frequent.select(word), word, "left_anti")
        met = met.union(others.join(model.filter(F.col("_n") < least), word).select(key, "_classes"))
    each = met.select(key, F.explode("_classes").alias("_m"))
    above = each.groupBy(key, F.col("_m._c").alias("_c")).agg(F.sum("_m.gain").alias("_above"))
    lengths = texts.select(key, "_length")
    base = F.get(doubles(prior), F.col("_c")) + F.col("_length") * F.get(doubles(absent), F.col("_c"))
    shared = written(above.join(lengths, key).select(key, "_c", (base + F.col("_above")).alias("_score")), "bayes-scores")
    first = shared.groupBy(key).agg(F.max("_score").alias("_best"))
    lines = F.zip_with(doubles(prior), doubles(absent), lambda p, a: p + F.col("_length") * a)
    alone = lengths.withColumn("_alone", lines)
    best = alone.join(first, key, "left").withColumn("_best", F.greatest(F.array_max("_alone"), "_best"))
    best = best.withColumn("_near", F.col("_best") - F.abs("_best") * NEAR)
    by_length = F.array_position(F.transform("_alone", lambda x: x >= F.col("_near")), True) - 1
    best = best.select(key, "_near", F.when(by_length >= 0, by_length).cast("int").alias("_lone"))
    near = shared.join(best.select(key, "_near"), key).filter(F.col("_score") >= F.col("_near"))
    found = best.select(key, "_lone").join(near.groupBy(key).agg(F.min("_c").alias("_c")), key, "left")
    known = F.array(*[F.lit(c) for c in labels])
    return found.select(key, F.get(known, F.least("_lone", "_c")).alias("prediction"))


def check_tree(algo: str, impurity: str) -> None:
    """Classification goes with Gini or Entropy, Regression with Variance."""
    fits = {"Classification": CLASS_IMPURITIES, "Regression": VALUE_IMPURITIES}
    if algo not in fits or impurity not in fits[algo]:
        raise ValueError(f"Algo {algo} is not compatible with impurity {impurity}.")


def fit_tree(
    rows: DataFrame,
    algo: str = "Classification",
    max_depth: int = 5,
    impurity: str = "Gini",
    max_bins: int = 100,
):
    """A decision tree on ``label, features``; parameters are checked before any job starts."""
    check_tree(algo, impurity)
    kind = DecisionTreeClassifier if algo == "Classification" else DecisionTreeRegressor
    model = kind(maxDepth=max_depth, impurity=impurity.lower(), maxBins=max_bins)
    with held(rows) as data:
        return model.fit(data)


def _impurity(kind: str, n: Column, s: Column, s2: Column) -> Column:
    """From row count, label sum and label square sum; for classes 0 and 1 the sum counts ones."""
    size = F.nullif(n, F.lit(0.0))
    mean = s / size
    if kind == "Variance":
        return s2 / size - mean * mean
    if kind == "Gini":
        return F.lit(1.0) - mean * mean - (1.0 - mean) * (1.0 - mean)
    bits = [F.when(p > 0, -p * F.log(p) / math.log(2.0)).otherwise(0.0) for p in (mean, 1.0 - mean)]
    return bits[0] + bits[1]


def _bin_sums(data: DataFrame, key: str) -> DataFrame:
    y = F.col("y")
    return data.groupBy(key).agg(
        F.count("*").cast("double").alias("n"), F.sum("y").alias("s"), F.sum(y * y).alias("s2")
    )


def _value_bins(data: DataFrame, max_bins: int) -> DataFrame | None:
    """One bin per distinct value, cut at the midpoints; None if there are more than ``max_bins``.

    A cheap estimate comes first, so a column with very many values is not grouped by value.
    """
    if data.agg(F.approx_count_distinct("x")).collect()[0][0] > 2 * max_bins:
        return None
    bins = _bin_sums(data, "x")
    if len(bins.select("x").limit(max_bins + 1).collect()) > max_bins:
        return None
    middle = (F.col("x") + F.lead("x").over(Window.orderBy("x"))) / 2
    return bins.select(F.col("x").alias("bin"), middle.alias("threshold"), "n", "s", "s2")


def _quantile_bins(data: DataFrame, max_bins: int) -> DataFrame:
    """At most ``max_bins`` bins cut at approximate quantiles; a value on a cut belongs below it.

    The bucketizer puts such values above, so it works on the negated column.
    """
    shares = [i / max_bins for i in range(1, max_bins)]
    found = data.agg(F.percentile_approx("x", shares, 10_000).alias("q")).collect()[0]["q"] or []
    cuts = sorted(set(found))
    splits = [-math.inf, *[-c for c in reversed(cuts)], math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol="_down", outputCol="_bucket")
    placed = bucketizer.transform(data.withColumn("_down", -F.col("x")))
    bins = _bin_sums(placed.withColumn("bin", F.lit(len(cuts)) - F.col("_bucket").cast("int")), "bin")
    return bins.withColumn("threshold", F.get(F.lit(cuts), F.col("bin")))


def root_splits(
    rows: DataFrame, label: str, feature: str, impurity: str = "Gini", max_bins: int = 100
) -> DataFrame:
    """Every candidate first split of one feature: ``threshold, gain``, and the gain's share of the impurity.

    Labels are 0 and 1 for Gini and Entropy, any number for Variance. Rows are first reduced to one
    per bin (at most ``max_bins``), which is all the windows see. With no more distinct values than
    bins every midpoint is tried; otherwise bins are cut at approximate quantiles.
    """
    check_tree("Regression" if impurity == "Variance" else "Classification", impurity)
    x, y = F.col(feature).cast("double"), F.col(label).cast("double")
    data = rows.select(x.alias("x"), y.alias("y"))
    bins = _value_bins(data, max_bins)
    if bins is None:
        bins = _quantile_bins(data, max_bins)
    left, every = Window.orderBy("bin"), Window.partitionBy()
    both = bins.select(
        "threshold",
        *[F.sum(c).over(left).alias(f"l_{c}") for c in ("n", "s", "s2")],
        *[F.sum(c).over(every).alias(f"t_{c}") for c in ("n", "s", "s2")],
    ).filter(F.col("l_n") < F.col("t_n"))

    def side(prefix: str) -> list[Column]:
        if prefix == "r":
            return [F.col(f"t_{c}") - F.col(f"l_{c}") for c in ("n", "s", "s2")]
        return [F.col(f"{prefix}_{c}") for c in ("n", "s", "s2")]

    whole, lower, upper = side("t"), side("l"), side("r")
    children = (
        _impurity(impurity, *lower) * lower[0] + _impurity(impurity, *upper) * upper[0]
    ) / whole[0]
    gain = _impurity(impurity, *whole) - children
    # relative to the node's impurity, so that labels on any scale are told apart alike
    share = F.coalesce(gain / F.nullif(_impurity(impurity, *whole), F.lit(0.0)), F.lit(0.0))
    return both.select("threshold", gain.alias("gain"), share.alias("share"))


def best_root_split(rows: DataFrame, label: str, feature: str, impurity: str = "Gini", max_bins: int = 100) -> DataFrame:
    """The split with the largest gain; among equals the lowest threshold."""
    every = root_splits(rows, label, feature, impurity, max_bins)
    order = [F.round("share", 12).desc(), F.col("threshold").asc()]
    return every.orderBy(*order).limit(1).drop("share")
