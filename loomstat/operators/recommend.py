"""Matrix-factor recommendation: fit, pair scores, top items of one user, RMSE."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions import above, clip_unit
from loomstat.operators import factor_blocks
from loomstat.operators.evaluate import rmse_over_pairs
from loomstat.operators.joins import join_lookup
from loomstat.operators.relational import mean_per_pair
from loomstat.session import ensure_checkpoint_dir, scratch_path, written

PAIR = ["user", "product"]
# A block of ratings is held by one task while its factors are solved. Every block is sent the factors it
# needs in each half-step, so more blocks than cores only add to what is shuffled.
RATINGS_PER_BLOCK = 20_000_000
# The library sends factors in every half-step, for each rating at most once. Where that may be more than so many
# bytes in a whole fit, the half-steps read them from the shared folder instead.
SENT_BYTES = 40_000_000_000


def fit_als(
    ratings: DataFrame,
    rank: int = 10,
    num_iterations: int = 20,
    reg_param: float = 1.0,
    implicit: bool = False,
    seed: int | None = None,
    blocks: int | None = None,
    sent_bytes: int = SENT_BYTES,
) -> ALSModel:
    """Alternating least squares on ``user int, product int, rating double``.

    Repeated pairs are averaged first, so no user holds more rows than there are items. The averaged pairs
    are written to the shared folder, as the library's fit reads its rows several times. The factor
    tables' lineage is cut every ten steps in the session's checkpoint folder.

    If the library might send more than ``sent_bytes``, it draws the start only and ``factor_blocks`` makes the same
    iterations from it; the factors are the same up to the rounding of single precision.
    """
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    pairs = written(mean_per_pair(ratings, PAIR), "pairs")
    n = pairs.count()
    cores = spark.sparkContext.defaultParallelism
    if blocks is None:
        blocks = max(10, cores, -(-n // RATINGS_PER_BLOCK))
    als = ALS(
        rank=rank, maxIter=num_iterations, regParam=reg_param, implicitPrefs=implicit, alpha=1.0,
        userCol="user", itemCol="product", ratingCol="rating", coldStartStrategy="drop",
        numUserBlocks=blocks, numItemBlocks=blocks,
    )
    if seed is not None:
        als = als.setSeed(seed)
    if 8 * rank * num_iterations * n <= sent_bytes:
        return als.fit(pairs)
    path = scratch_path(spark, "model")
    als.setMaxIter(0).fit(pairs).save(path)
    start = spark.read.parquet(f"{path}/userFactors")
    dealt = factor_blocks.block_count(n, rank, cores)
    users, items = factor_blocks.iterate(pairs, start, rank, num_iterations, reg_param, implicit, 1.0, dealt)
    users.write.mode("overwrite").parquet(f"{path}/userFactors")
    items.write.mode("overwrite").parquet(f"{path}/itemFactors")
    return ALSModel.load(path)


def _dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def score_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add ``prediction``; pairs with a user or item the model has not seen are dropped.

    A user with very many pairs is spread over tasks by product, and a product by user.
    """
    row_bytes = 8 * model.rank + 32
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("_user"))
    items = model.itemFactors.select(F.col("id").alias("product"), F.col("features").alias("_item"))
    scored = join_lookup(pairs, users, "user", F.col("product"), row_bytes)
    scored = join_lookup(scored, items, "product", F.col("user"), row_bytes)
    return scored.select(*pairs.columns, _dot("_user", "_item").alias("prediction"))


def recommender_rmse(model: ALSModel, test: DataFrame, implicit: bool = False) -> DataFrame:
    """RMSE over the predicted pairs; implicit mode compares clipped scores with 0 and 1.

    Predictions join ratings on the pair, so a pair rated k times weighs k * k. Each pair is scored
    once and its copies enter as a count. The pairs are written to the shared folder, as looking them up
    reads them several times.
    """
    rating = above(F.col("rating")) if implicit else F.col("rating")
    actual = written(test.groupBy(*PAIR, rating.alias("rating")).agg(F.count("*").alias("_same")), "tested")
    pairs = written(actual.groupBy(*PAIR).agg(F.sum("_same").alias("_all")), "tested")
    scored = score_pairs(model, pairs)
    if implicit:
        scored = scored.withColumn("prediction", clip_unit(F.col("prediction")))
    joined = scored.join(actual, PAIR).withColumn("n_rows", F.col("_all") * F.col("_same"))
    return rmse_over_pairs(joined)


def top_items(model: ALSModel, user: int, k: int = 10) -> DataFrame:
    """The user's k best items, rated ones included: ``product, rating``.

    One user's factors are ``rank`` numbers: they become constants, and the item factors are
    scored where they lie. No join, and each task keeps k rows.
    """
    row = model.userFactors.filter(F.col("id") == user).first()
    factors = [float(f) for f in row["features"]] if row else []
    items = model.itemFactors
    if not factors:
        items = items.filter(F.lit(False))
    score = _dot("features", F.lit(factors or [0.0]))
    scored = items.select(F.col("id").alias("product"), score.alias("rating"))
    return scored.orderBy(F.col("rating").desc(), F.col("product").asc()).limit(k)
