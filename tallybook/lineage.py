"""Frames that several branches read are computed once and kept in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes a query's shuffle files when it ends; else they stay until the driver's garbage collector finds them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The folders of frames that were stored.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: the copy is read from then on, never what it was made from."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session, else the warehouse.

    Both are shared by definition, so the same happens in a local session and on a cluster.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def compute_once(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder as Parquet and go on from there.

    The copy outlives the executors that made it; a branch reads only the columns it needs, and the planner
    knows the copy's size.
    """
    path = f"{shared_folder(df.sparkSession)}/once-{uuid.uuid4().hex}"
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return kept_in(path, df.sparkSession.read.schema(df.schema).parquet(path))


def kept_in(path: str, frame: DataFrame) -> DataFrame:
    """The frame, for ``drop`` to know the folder it reads."""
    _folders[frame] = path
    return frame


def drop(*frames: DataFrame) -> None:
    """Deletes the copies of frames as they were stored; no frame that is still to be computed may read them."""
    for frame in frames:
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(_folders.pop(frame))
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
