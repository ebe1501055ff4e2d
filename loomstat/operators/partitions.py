"""Keeping all cores busy on inputs of few partitions, and holding rows over repeated passes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def at_least_partitions(df: DataFrame, wanted: int | None = None) -> DataFrame:
    """Spread rows over ``wanted`` partitions (default: the cluster's cores) if they are in fewer
    than half as many.

    A file with one large row group is read by one task. Moving its rows once pays when what follows
    is heavy; an input of many files is left alone. Meant for frames that only scan and project:
    looking at the partitions of a shuffled frame would run its shuffle.
    """
    wanted = wanted or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() * 2 <= wanted else df


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """The rows, kept on the executors (memory, then disk) for the passes made inside the block.

    Lost blocks are computed again from the source.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if kept.rdd.getNumPartitions() * 2 <= wanted:
        kept.unpersist()
        kept = df.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
