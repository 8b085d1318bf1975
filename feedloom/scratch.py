"""Where intermediate tables live: the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    A throw-away folder is used only on a local master that has none set. On a
    cluster a machine-local folder would lose data with its executor, so there
    the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="feedloom-"))
    return context.getCheckpointDir().rstrip("/")


#: Paths given out in this process and not yet released.
_given: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, for one intermediate table.

    Results may read from it until they are written or collected, so nothing removes it
    by itself: whoever runs the queries calls ``release`` when done with their results.
    """
    path = f"{shared_folder(spark)}/feedloom/{label}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there, wherever Spark can reach it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of this process; results not yet read are lost."""
    while _given:
        remove(spark, _given.pop())
