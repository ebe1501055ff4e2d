"""Words, filters, casts, counts, joins, order, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.functions import (
    above,
    at_least,
    cast_or_default,
    clip_unit,
    implicit_confidence,
    log_label,
    number_text,
    strict_cast,
)
from loomstat.operators import relational
from loomstat.operators.ordering import top_k, with_row_index
from loomstat.operators.partitions import at_least_partitions
from loomstat.operators.sampling import bottom_k, in_share
from loomstat.plans.catalog.base import RATINGS_SQL, query, ratings, rounded, table

WORDS_SQL = r"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(text, '[ \r\n]')) AS word FROM documents)
    WHERE length(word) + length(regexp_replace(word, '[^\x{10000}-\x{10FFFF}]', '', 'g')) > 3
    GROUP BY word
"""


def _falling():
    return [F.col("n").desc(), F.col("word").asc()]


@query("word_count", WORDS_SQL)
def word_count(spark, folder):
    documents = at_least_partitions(table(spark, folder, "documents").select("text"))
    return relational.word_count(documents, "text")


@query(
    "word_count_sorted",
    f"SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS row_index FROM ({WORDS_SQL})",
)
def word_count_sorted(spark, folder):
    return with_row_index(word_count(spark, folder), _falling())


@query("word_count_top10", f"{WORDS_SQL} ORDER BY n DESC, word LIMIT 10")
def word_count_top10(spark, folder):
    return top_k(word_count(spark, folder), _falling(), 10)


@query("row_preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 20")
def row_preview(spark, folder):
    return top_k(table(spark, folder, "customer"), [F.col("c_custkey").asc()], 20)


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(
    "table_columns",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count({c}) AS n_values FROM customer"
        for i, c in enumerate(CUSTOMER_COLUMNS, start=1)
    ),
)
def table_columns(spark, folder):
    return relational.column_listing(table(spark, folder, "customer"))


@query("filter_gt", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 21")
def filter_gt(spark, folder):
    customer = table(spark, folder, "customer").filter(F.col("c_acctbal") > 21)
    return customer.select("c_custkey", "c_name", "c_acctbal")


@query(
    "typed_table",
    "SELECT c_nationkey AS age, count(*) AS n, round(avg(c_acctbal), 6) AS avg_balance FROM customer"
    " WHERE c_nationkey > 21 GROUP BY c_nationkey",
)
def typed_table(spark, folder):
    people = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("age"), "c_acctbal"
    )
    people.createOrReplaceTempView("people")
    return spark.sql(
        "SELECT age, count(*) AS n, round(avg(c_acctbal), 6) AS avg_balance"
        " FROM people WHERE age > 21 GROUP BY age"
    )


@query(
    "parse_typed",
    "SELECT c_name AS name, c_nationkey AS age, c_acctbal AS balance FROM customer",
)
def parse_typed(spark, folder):
    padded = table(spark, folder, "customer").select(
        F.concat_ws(
            ",", "c_name", F.concat(F.lit("  "), F.col("c_nationkey")), F.concat(F.col("c_acctbal"), F.lit(" "))
        ).alias("line")
    )
    part = F.split("line", ",")
    return padded.select(
        F.get(part, 0).alias("name"),
        strict_cast(F.get(part, 1), "int").alias("age"),
        strict_cast(F.get(part, 2), "double").alias("balance"),
    )


@query(
    "cast_or_default",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 40.0::DOUBLE END AS full_sq
       FROM lineitem""",
)
def cast_default(spark, folder):
    # three kinds of cells: a number, a mark for "not available", nothing
    cell = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("string")).when(
        F.col("l_returnflag") == "A", F.lit("NA")
    )
    lines = table(spark, folder, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", cast_or_default(cell, 40.0).alias("full_sq"))


@query(
    "log_label",
    "SELECT p_partkey, round(ln(p_retailprice + 1), 6) AS label FROM part",
)
def log_labels(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", rounded(log_label(F.col("p_retailprice"))).alias("label")
    )


@query(
    "implicit_confidence",
    f"SELECT user_id, product_id, rating - 2.5::DOUBLE AS confidence FROM ({RATINGS_SQL})",
)
def confidences(spark, folder):
    return ratings(spark, folder).select(
        F.col("user").alias("user_id"),
        F.col("product").alias("product_id"),
        implicit_confidence(F.col("rating")).alias("confidence"),
    )


@query(
    "binarize",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_quantity - 25 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS margin_class,
              CASE WHEN l_quantity / 50 < 0.5 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS cut_class
       FROM lineitem""",
)
def binarize(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        above(F.col("l_quantity") - 25).alias("margin_class"),
        at_least(F.col("l_quantity") / 50).alias("cut_class"),
    )


@query(
    "clip_unit",
    """SELECT c_custkey, greatest(least(c_acctbal / 5000, 1.0::DOUBLE), 0.0::DOUBLE) AS clipped
       FROM customer""",
)
def clipped(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", clip_unit(F.col("c_acctbal") / 5000).alias("clipped")
    )


@query(
    "weights_text",
    """SELECT l_returnflag,
              printf('%.4f,%.4f,%.4f', avg(l_quantity), avg(l_discount), avg(l_extendedprice)) AS weights
       FROM lineitem GROUP BY l_returnflag""",
)
def weights_text(spark, folder):
    grouped = table(spark, folder, "lineitem").groupBy("l_returnflag")
    text = number_text(F.avg("l_quantity"), F.avg("l_discount"), F.avg("l_extendedprice"))
    return grouped.agg(text.alias("weights"))


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, folder):
    return relational.row_count(table(spark, folder, "lineitem"))


@query(
    "ratings_profile",
    f"""SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
               count(DISTINCT product_id) AS n_items FROM ({RATINGS_SQL})""",
)
def ratings_profile(spark, folder):
    return relational.ratings_profile(ratings(spark, folder))


@query(
    "global_max_avg",
    """SELECT max(c_nationkey) AS max_c_nationkey, round(avg(c_acctbal), 6) AS avg_c_acctbal
       FROM customer""",
)
def global_max_avg(spark, folder):
    one = relational.global_max_avg(table(spark, folder, "customer"), "c_nationkey", "c_acctbal")
    return one.withColumn("avg_c_acctbal", rounded("avg_c_acctbal"))


@query(
    "predicate_share",
    """SELECT round(avg(CASE WHEN l_quantity > 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share
       FROM lineitem""",
)
def predicate_share(spark, folder):
    share = relational.predicate_share(table(spark, folder, "lineitem"), F.col("l_quantity") > 25)
    return share.select(rounded("share").alias("share"))


PREDICTED_SQL = "((user_id * 31 + product_id * 17) % 50) / 10.0::DOUBLE"


def scored_ratings(spark, folder):
    """Ratings and, for three users of four, a prediction computed from the pair."""
    actual = ratings(spark, folder)
    predicted = actual.filter(F.col("user") % 4 != 0).select(
        "user", "product", ((F.col("user") * 31 + F.col("product") * 17) % 50 / 10.0).alias("prediction")
    )
    return predicted, actual


SCORED_SQL = f"""
    WITH actual AS ({RATINGS_SQL}),
    predicted AS (SELECT user_id, product_id, {PREDICTED_SQL} AS prediction
                  FROM actual WHERE user_id % 4 <> 0)
"""


@query(
    "join_pred_actual",
    f"""{SCORED_SQL}
    SELECT p.user_id, p.product_id, round(prediction, 6) AS prediction, rating, count(*) AS n_rows
    FROM predicted p JOIN actual a ON p.user_id = a.user_id AND p.product_id = a.product_id
    GROUP BY ALL""",
)
def join_pred_actual(spark, folder):
    predicted, actual = scored_ratings(spark, folder)
    joined = relational.join_pairs(predicted, actual, ["user", "product"])
    return joined.select(
        F.col("user").alias("user_id"),
        F.col("product").alias("product_id"),
        rounded("prediction").alias("prediction"),
        "rating",
        "n_rows",
    )


@query(
    "rank_predictions",
    """SELECT p_partkey AS product, round(score, 6) AS prediction,
              row_number() OVER (ORDER BY score DESC, p_partkey) AS row_index
       FROM (SELECT p_partkey, (p_partkey * 7919 % 1000) / 200.0::DOUBLE AS score FROM part)""",
)
def rank_predictions(spark, folder):
    scored = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product"), (F.col("p_partkey") * 7919 % 1000 / 200.0).alias("prediction")
    )
    return with_row_index(scored, [F.col("prediction").desc(), F.col("product").asc()])


@query(
    "split_80_20",
    """SELECT o_orderkey,
              concat('0x', substr(md5(o_orderkey::VARCHAR), 1, 4))::INT < 52429 AS training
       FROM orders""",
)
def split_80_20(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", in_share(0.8, F.col("o_orderkey")).alias("training")
    )


@query(
    "sample_per_class",
    """SELECT o_orderkey, o_orderstatus FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_orderstatus
         ORDER BY concat('0x', substr(md5(o_orderkey::VARCHAR), 1, 13))::BIGINT, o_orderkey) <= 200""",
)
def sample_per_class(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return bottom_k(orders, "o_orderkey", 200, by="o_orderstatus", tie=["o_orderkey"])
