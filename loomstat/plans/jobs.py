"""Whole jobs: rows in, training, scoring of held-out rows, one report row out.

Rows are split 80 / 20 by a key column, so a run can be repeated. Each report needs one pass over
the scored rows; training and test rows are told apart inside that pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions import cast_or_default, log_label, number_text, strict_cast, words
from loomstat.operators import classify, descent, evaluate, recommend
from loomstat.operators.features import assemble
from loomstat.operators.ordering import top_k
from loomstat.operators.partitions import held
from loomstat.operators.relational import ratings_profile, word_count
from loomstat.operators.sampling import in_share, split_by_key
from loomstat.operators.series import FEATURES, array_features
from loomstat.sources import write_text

TRAIN_SHARE = 0.8
DEFAULT_AREA = 40.0


def count_words(lines: DataFrame, text: str, folder: str, longer: int = 3) -> DataFrame:
    """Count words, write ``(count,word)`` lines in falling order, return the ten most frequent."""
    counts = word_count(lines, text, longer)
    order = [F.col("n").desc(), F.col("word").asc()]
    line = F.concat(F.lit("("), F.col("n").cast("string"), F.lit(","), F.col("word"), F.lit(")"))
    write_text(counts.orderBy(*order), line, folder)
    written = lines.sparkSession.read.text(folder)  # the words are counted once
    cell = F.regexp_extract("value", r"^\((\d+),(.*)\)$", 1).cast("long")
    word = F.regexp_extract("value", r"^\((\d+),(.*)\)$", 2)
    return top_k(written.select(cell.alias("n"), word.alias("word")).select(*counts.columns), order, 10)


def sales_rows(cells: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text cells to ``label, full_sq, life_sq``; only ``full_sq`` may be missing or malformed."""
    return cells.select(
        *keep,
        log_label(strict_cast(F.col("price_doc"), "double")).alias("label"),
        cast_or_default(F.col("full_sq"), DEFAULT_AREA).alias("full_sq"),
        strict_cast(F.col("life_sq"), "double").alias("life_sq"),
    )


def _train(key: str) -> Column:
    return in_share(TRAIN_SHARE, F.col(key))


def _split_counts(train: Column) -> list[Column]:
    return [F.count_if(train).alias("n_training"), F.count_if(~train).alias("n_test")]


def _vectors(rows: DataFrame, label: str, features: str | Sequence[str], key: str) -> DataFrame:
    """``key, label, features``; features are named columns, or a vector column already."""
    joined = rows.withColumn("features", F.col(features)) if isinstance(features, str) else assemble(rows, features)
    return joined.select(key, F.col(label).cast("double").alias("label"), "features")


def linear_regression(
    rows: DataFrame,
    label: str,
    features: str | Sequence[str],
    key: str,
    num_iterations: int = 100,
    step_size: float = 1.0,
    reg_type: str = "L2",
    reg_param: float = 0.1,
) -> DataFrame:
    """``n_training, n_test, weights, rmse``: fit on 80 %, RMSE on the rest."""
    training, _ = split_by_key(rows, key, TRAIN_SHARE)
    model = descent.linear_regression(
        training, label, features, num_iterations, step_size, reg_type, reg_param
    )
    train = _train(key)
    error = descent.margin(features, model.weights) - F.col(label)
    return rows.agg(
        *_split_counts(train),
        number_text(*[F.lit(w) for w in model.weights]).alias("weights"),
        F.sqrt(F.avg(F.when(~train, error * error))).alias("rmse"),
    )


def sales_regression(
    cells: DataFrame,
    key: str,
    num_iterations: int = 100,
    step_size: float = 0.001,
    reg_type: str = "L2",
    reg_param: float = 0.1,
) -> DataFrame:
    """Regress the log price on two areas, starting from text cells."""
    rows = sales_rows(cells, [key])
    return linear_regression(
        rows, "label", ["full_sq", "life_sq"], key, num_iterations, step_size, reg_type, reg_param
    )


def _binary_report(scored: DataFrame, train: Column, report: Sequence[Column]) -> DataFrame:
    """One row of counts and further measures, beside the two areas of the test rows.

    The scores are worked out once and kept on the executors for the passes over them.
    """
    with held(scored) as kept:
        one = kept.agg(*_split_counts(train), *report)
        found = one.first()
        areas = evaluate.binary_areas(kept.filter(~train))
        cells = [*zip(one.schema, found), *zip(areas.schema, areas.first())]
    return scored.sparkSession.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in cells])


def svm_classification(
    rows: DataFrame,
    label: str,
    features: str | Sequence[str],
    key: str,
    num_iterations: int = 100,
    step_size: float = 1.0,
    reg_param: float = 0.1,
) -> DataFrame:
    """``n_training, n_test, accuracy (in percent), auc_roc, auc_pr`` of a linear SVM with L1."""
    training, _ = split_by_key(rows, key, TRAIN_SHARE)
    model = descent.linear_svm(training, label, features, num_iterations, step_size, "L1", reg_param)
    score = descent.margin(features, model.weights)
    scored = rows.select(key, F.col(label).cast("double").alias("label"), score.alias("prediction"))
    train = _train(key)
    hit = F.when(evaluate.margin_class() == F.col("label"), 1.0).otherwise(0.0)
    return _binary_report(scored, train, [(F.avg(F.when(~train, hit)) * 100).alias("accuracy")])


def series_anomaly(
    rows: DataFrame,
    label: str,
    points: str,
    key: str,
    num_iterations: int = 100,
    step_size: float = 1.0,
    reg_param: float = 0.1,
) -> DataFrame:
    """Seven features per series, then the SVM on them."""
    featured = array_features(rows, points, [key, label])
    return svm_classification(featured, label, FEATURES, key, num_iterations, step_size, reg_param)


def logistic_classification(
    rows: DataFrame,
    label: str,
    features: str | Sequence[str],
    key: str,
    num_iterations: int = 100,
    reg_type: str = "L2",
    reg_param: float = 0.1,
    **fit,
) -> DataFrame:
    """``n_training, n_test, auc_roc, auc_pr`` of a logistic regression."""
    vectors = _vectors(rows, label, features, key)
    training, _ = split_by_key(vectors, key, TRAIN_SHARE)
    model = classify.fit_logistic(training, num_iterations, reg_type, reg_param, **fit)
    return _binary_report(classify.probability_of_one(model, vectors), _train(key), [])


def naive_bayes(
    rows: DataFrame, label: str, features: str | Sequence[str], key: str, smoothing: float = 1.0
) -> DataFrame:
    """``n_training, n_test, accuracy`` of a multinomial naive Bayes model.

    Named count columns make a model table; a vector column goes through the library's model.
    """
    if isinstance(features, str):
        rows, label = _vectors(rows, label, features, key), "label"
        training, _ = split_by_key(rows, key, TRAIN_SHARE)
        scored = classify.fit_naive_bayes(training, smoothing).transform(rows)
    else:
        training, _ = split_by_key(rows, key, TRAIN_SHARE)
        table = classify.naive_bayes_table(training, label, features, smoothing)
        scored = classify.naive_bayes_score(rows, table, label, features)
    train = _train(key)
    hit = F.when(F.col("prediction") == F.col(label), 1.0).otherwise(0.0)
    return scored.agg(*_split_counts(train), F.avg(F.when(~train, hit)).alias("accuracy"))


def decision_tree(
    rows: DataFrame,
    label: str,
    features: str | Sequence[str],
    key: str,
    algo: str = "Classification",
    max_depth: int = 5,
    impurity: str = "Gini",
    max_bins: int = 100,
) -> DataFrame:
    """``n_training, n_test`` and ``accuracy`` or ``mse`` of a tree on the held-out rows."""
    classify.check_tree(algo, impurity)
    vectors = _vectors(rows, label, features, key)
    training, _ = split_by_key(vectors, key, TRAIN_SHARE)
    scored = classify.fit_tree(training, algo, max_depth, impurity, max_bins).transform(vectors)
    train = _train(key)
    if algo == "Classification":
        hit = F.when(evaluate.cut_class() == F.col("label"), 1.0).otherwise(0.0)
        quality = F.avg(F.when(~train, hit)).alias("accuracy")
    else:
        error = F.col("prediction") - F.col("label")
        quality = F.avg(F.when(~train, error * error)).alias("mse")
    return scored.agg(*_split_counts(train), quality)


def recommender(
    ratings: DataFrame,
    key: str,
    rank: int = 10,
    num_iterations: int = 20,
    reg_param: float = 1.0,
    implicit: bool = False,
    user: int = 0,
    seed: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Profile of the ratings, RMSE on held-out ones, and the user's ten best items.

    In implicit mode ``rating`` must already hold confidences.
    """
    training, test = split_by_key(ratings, key, TRAIN_SHARE)
    model = recommend.fit_als(training, rank, num_iterations, reg_param, implicit, seed)
    return (
        ratings_profile(ratings),
        recommend.recommender_rmse(model, test, implicit),
        recommend.top_items(model, user, 10),
    )


def word_features(documents: DataFrame, text: str, vocabulary: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """How often each word of a short list occurs in each whole text, one column per word."""
    known = F.filter(words(text), lambda w: w.isin(list(vocabulary)))
    held = documents.select(*keep, known.alias("_known"))

    def times(word: str) -> Column:
        return F.size(F.filter("_known", lambda w: w == F.lit(word))).cast("double").alias(f"n_{word}")

    return held.select(*keep, *[times(word) for word in vocabulary])
