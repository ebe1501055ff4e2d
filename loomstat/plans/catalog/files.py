"""Every reader and the text writer, on files written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.functions import strict_cast
from loomstat.operators import relational
from loomstat.operators.features import assemble
from loomstat.plans.catalog.base import RATINGS_SQL, query, ratings, rounded, table
from loomstat.plans.catalog.tables import WORDS_SQL, word_count
from loomstat.session import scratch_path
from loomstat.sources import (
    read_csv_by_name,
    read_delimited,
    read_double_rows,
    read_labeled_dense,
    read_libsvm,
    read_lines,
    write_text,
)
from loomstat.sources.files import unpack_vector


@query(
    "src_text",
    r"""SELECT value, count(*) AS n
        FROM (SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS value FROM documents)
        GROUP BY value""",
)
def src_text(spark, folder):
    path = scratch_path(spark, "text")
    write_text(table(spark, folder, "documents"), F.col("text"), path)
    return read_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


@query("src_delimited", RATINGS_SQL)
def src_delimited(spark, folder):
    # the fourth field is ignored by the reader
    path = scratch_path(spark, "ratings")
    line = F.concat_ws("::", "user", "product", F.col("rating"), F.lit("ignored"))
    write_text(ratings(spark, folder), line, path)
    columns = [("user_id", "int"), ("product_id", "int"), ("rating", "double")]
    return read_delimited(spark, path, columns, "::")


@query(
    "src_people",
    "SELECT c_name AS name, c_nationkey AS age, c_custkey::INT AS salary FROM customer",
)
def src_people(spark, folder):
    path = scratch_path(spark, "people")
    write_text(
        table(spark, folder, "customer"), F.concat_ws(", ", "c_name", "c_nationkey", "c_custkey"), path
    )
    return read_delimited(spark, path, [("name", "string"), ("age", "int"), ("salary", "int")])


@query(
    "src_double_rows",
    """SELECT vec_id, label::DOUBLE AS label, len(embedding) AS n_points,
              round(list_sum(embedding::DOUBLE[]), 6) AS total, round(embedding[1]::DOUBLE, 6) AS first_point
       FROM embeddings""",
)
def src_double_rows(spark, folder):
    path = scratch_path(spark, "series")
    points = F.transform("embedding", lambda v: v.cast("double").cast("string"))
    write_text(
        table(spark, folder, "embeddings"), F.concat_ws(",", "vec_id", "label", points), path
    )
    cells = read_double_rows(spark, path)
    series = F.slice("cells", 3, F.size("cells") - 2)
    return cells.select(
        F.get("cells", 0).cast("long").alias("vec_id"),
        F.get("cells", 1).alias("label"),
        F.size(series).cast("long").alias("n_points"),
        rounded(F.aggregate(series, F.lit(0.0), lambda total, v: total + v)).alias("total"),
        rounded(F.get(series, 0)).alias("first_point"),
    )


@query(
    "src_csv_header",
    "SELECT p_partkey, p_name || ', \"' || p_brand || '\"' AS title, p_retailprice AS price_doc FROM part",
)
def src_csv_header(spark, folder):
    path = scratch_path(spark, "parts")
    titled = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_size", F.col("p_retailprice").alias("price_doc"), titled.alias("title")
    )
    parts.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    cells = read_csv_by_name(spark, path, ["p_partkey", "title", "price_doc"])
    return cells.select(
        strict_cast(F.col("p_partkey"), "bigint").alias("p_partkey"),
        "title",
        strict_cast(F.col("price_doc"), "double").alias("price_doc"),
    )


@query(
    "src_libsvm",
    """SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
              l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem""",
)
def src_libsvm(spark, folder):
    path = scratch_path(spark, "libsvm")
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        "l_quantity",
        "l_discount",
        "l_tax",
    )
    vectors = assemble(lines, ["l_quantity", "l_discount", "l_tax"]).select("label", "features")
    vectors.write.mode("overwrite").format("libsvm").save(path)
    return unpack_vector(read_libsvm(spark, path, num_features=3), "features", ["f0", "f1", "f2"])


@query(
    "src_labeled_dense",
    "SELECT p_size::DOUBLE AS label, p_partkey::DOUBLE AS f0, p_retailprice AS f1 FROM part",
)
def src_labeled_dense(spark, folder):
    path = scratch_path(spark, "dense")
    line = F.concat("p_size", F.lit(","), F.concat_ws(" ", "p_partkey", "p_retailprice"))
    write_text(table(spark, folder, "part"), line, path)
    rows = read_labeled_dense(spark, path)
    return rows.select("label", *[F.get("features", i).alias(f"f{i}") for i in range(2)])


@query(
    "src_generated",
    f"""SELECT 0 AS user_id, unnest(range(count(DISTINCT product_id)))::INT AS product_id,
               0.0::DOUBLE AS rating FROM ({RATINGS_SQL})""",
)
def src_generated(spark, folder):
    """Candidate pairs for one user, generated on the executors from the number of rated items."""
    n_items = relational.ratings_profile(ratings(spark, folder)).first()["n_items"]
    return spark.range(n_items).select(
        F.lit(0).alias("user_id"), F.col("id").cast("int").alias("product_id"), F.lit(0.0).alias("rating")
    )


@query("sink_text_roundtrip", f"SELECT n, word FROM ({WORDS_SQL})")
def sink_text_roundtrip(spark, folder):
    path = scratch_path(spark, "results")
    falling = word_count(spark, folder).orderBy(F.col("n").desc(), F.col("word").asc())
    line = F.concat(F.lit("("), F.col("n").cast("string"), F.lit(","), F.col("word"), F.lit(")"))
    write_text(falling, line, path)
    lines = read_lines(spark, path)
    comma = F.locate(",", "value")
    return lines.select(
        F.expr("substr(value, 2, locate(',', value) - 2)").cast("bigint").alias("n"),
        F.col("value").substr(comma + 1, F.length("value") - comma - 1).alias("word"),
    )
