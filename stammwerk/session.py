"""Session settings the jobs are designed for, and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# For spark-submit or a session builder. The library never changes a caller's session.
RECOMMENDED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key on the preserved side of a left join is split even where that
    # costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables bucketed by one of several join columns are joined without a shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    A machine-local folder is made only for a local master, where one machine
    is the whole cluster.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stammwerk-")


_made: list[str] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def made_paths() -> list[str]:
    """The folders of intermediate data this process has made and not cleaned up, in order."""
    return _made.copy()


def clean_up(spark: SparkSession) -> int:
    """Delete the intermediate data this process has made so far; returns how many folders.

    For when every result that was built on them has been written. Frames that read them
    fail afterwards.
    """
    paths = _made.copy()
    _made.clear()
    for path in paths:
        remove(spark, path)
    return len(paths)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind; the setting is put back after it.

    Spark would keep them until the driver's garbage is collected, so that steps that store
    something would add up on disk.
    """
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)


def stored_at(df: DataFrame, label: str) -> tuple[str, DataFrame]:
    """Write ``df`` to the shared folder and read it back: later steps start from there.

    The path is for removing the files once they have been read for the last time.
    """
    path = fresh_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    return stored_at(df, label)[1]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
