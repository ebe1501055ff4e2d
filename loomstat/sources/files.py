"""Flat files to typed DataFrames and back.

Every reader has a fixed schema: nothing is inferred, so no reader scans its input ahead of the
query (``read_libsvm`` without a feature count is the one exception, as the width is then data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.functions import fields, strict_cast
from loomstat.operators.partitions import at_least_partitions


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line in column ``value``; spread wider only if ``min_partitions`` asks for it."""
    df = spark.read.text(path)
    return at_least_partitions(df, min_partitions) if min_partitions else df


def _field(parts: Column, i: int, wanted: int) -> Column:
    short = F.raise_error(F.concat(F.lit(f"expected {wanted} fields: "), F.concat_ws("|", parts)))
    return F.when(F.size(parts) > i, F.get(parts, i)).otherwise(short.cast("string"))


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[tuple[str, str]],
    sep: str = ",",
) -> DataFrame:
    """Records by position, e.g. ``[("name", "string"), ("age", "int")]``.

    Fields past the last column are ignored; too few fields or a bad number stop the job. String
    fields are kept as they are, numbers are trimmed first.
    """
    parts = fields("value", sep)
    out = []
    for i, (name, data_type) in enumerate(columns):
        cell = _field(parts, i, len(columns))
        out.append((cell if data_type == "string" else strict_cast(cell, data_type)).alias(name))
    return spark.read.text(path).select(*out)


def read_double_rows(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Rows of any width, every cell a double, as ``array<double>`` in column ``cells``."""
    cells = F.transform(fields("value", sep), lambda cell: strict_cast(cell, "double"))
    return spark.read.text(path).select(cells.alias("cells"))


def read_csv_by_name(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    escape: str = '"',
) -> DataFrame:
    """Text columns picked by their header names.

    Every file must have the same columns in the same order; one that differs stops the job. Rows that repeat the header's first cell are dropped wherever they stand, not only at the top
    of a file.
    """
    df = spark.read.option("header", True).option("escape", escape).option("enforceSchema", False).csv(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such column in the header: {', '.join(missing)}")
    first = df.columns[0]
    return df.filter(~F.col(first).eqNullSafe(F.lit(first))).select(*columns)


def read_libsvm(
    spark: SparkSession,
    path: str,
    num_features: int = -1,
    min_partitions: int | None = None,
) -> DataFrame:
    """``label double, features vector`` with indices from 0; labels are kept as they stand.

    Naming the number of features spares a pass over the input that looks for the largest index.
    """
    reader = spark.read.format("libsvm")
    if num_features > 0:
        reader = reader.option("numFeatures", num_features)
    df = reader.load(path)
    return at_least_partitions(df, min_partitions) if min_partitions else df


def read_labeled_dense(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``label,f0 f1 f2 ...`` as ``label double, features array<double>``."""
    parts = F.split("value", ",")
    cells = F.transform(fields(F.trim(_field(parts, 1, 2)), " "), lambda cell: strict_cast(cell, "double"))
    return spark.read.text(path).select(
        strict_cast(_field(parts, 0, 2), "double").alias("label"), cells.alias("features")
    )


def unpack_vector(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one double column per slot."""
    slots = vector_to_array(F.col(vector))
    rest = [c for c in df.columns if c != vector]
    return df.select(*rest, *[F.get(slots, i).alias(n) for i, n in enumerate(names)])


def write_text(df: DataFrame, line: Column, path: str) -> None:
    """Replace ``path`` by part files of one text line per row, in the row order of ``df``."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)
