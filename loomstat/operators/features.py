"""Between named number columns and the vector columns that ``pyspark.ml`` wants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Add a vector of these columns; a missing value stops the job."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)


def from_array(df: DataFrame, array: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(array)))
