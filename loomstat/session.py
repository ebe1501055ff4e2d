"""Where a job may keep intermediate data.

A cluster names one shared folder in ``spark.checkpoint.dir``; everything written between two
stages of a job goes below it, so a lost executor never takes the data with it.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folders: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Return the folder named by the session; only a local master may fall back to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        _own_folders.append(tempfile.mkdtemp(prefix="loomstat-"))
        sc.setCheckpointDir(_own_folders[-1])
    return sc.getCheckpointDir().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable, keeping a folder that is already set."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


_written: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for one written table, new on every call; what is there goes when the driver ends."""
    path = f"{shared_folder(spark)}/loomstat/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back from there by every later pass."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one written table, in whatever store it is."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def drop_scratch() -> None:
    """Delete the tables written so far, as long as their session still runs."""
    for spark, path in _written:
        sc = spark.sparkContext
        if sc._jsc is None or sc._jsc.sc().isStopped():
            continue
        delete_path(spark, path)
    _written.clear()


@atexit.register
def _at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone first
        drop_scratch()
    for folder in _own_folders:
        shutil.rmtree(folder, ignore_errors=True)
