"""What the operators share: table access, row packing, fold numbers and sizes checked before use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables up to this many bytes, counted first, are sent to every executor.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's text modulo ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """The whole row as one struct ``row``, beside working columns that cannot clash with its names."""
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in more.items()])


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row; maps, which have no hash, are hashed as JSON."""
    cells = []
    for f in df.schema.fields:
        cell = F.col(f"`{f.name}`")
        cells.append(F.to_json(F.struct(cell)) if "map<" in f.dataType.simpleString() else cell)
    return F.xxhash64(*cells)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """The frame, marked for broadcast if its counted rows stay below the limit."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def map_texts(
    df: DataFrame,
    keep: Sequence[Column],
    text: Column,
    fields: Sequence[tuple[str, T.DataType]],
    work: Callable[[pa.Array], Sequence[pa.Array | np.ndarray]],
) -> DataFrame:
    """``keep`` as columns k0, k1, ... and the columns that ``work`` makes of each batch of texts.

    The texts go to Python in Arrow batches and do not come back unless ``keep`` holds them. Nothing
    is shuffled, and a lost task is simply run again.
    """
    rows = df.select(*[c.alias(f"k{i}") for i, c in enumerate(keep)], text.cast("string").alias("t"))
    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(n, kind) for n, kind in fields]])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(c) for c in work(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)
