"""Publishing that can be stopped and goes on where it stopped.

An ordering is published in stretches of positions. Each has one entry in a manifest, added
after the stretch is written whole. A later run writes only stretches without an entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import scratch
from feedloom.operators.ordering import read_stretch, version_of
from feedloom.sources.files import read_ordered_lines

ENTRY = "stretch INT, stretches INT, version INT, first_pos BIGINT, last_pos BIGINT"


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's entries."""
    if scratch.exists(spark, f"{path}/manifest"):
        return spark.read.schema(ENTRY).parquet(f"{path}/manifest")
    return spark.createDataFrame([], ENTRY)


def publish_resumed(
    spark: SparkSession, stored: str, path: str, stretches: int, tasks: int,
    write: Callable[[DataFrame, int], None] | None = None, stop_before: int | None = None,
) -> list[int]:
    """Publish a stored ordering in ``stretches``, each by ``tasks`` tasks; returns those written now.

    ``write(rows, stretch)`` gets ``pos, raw`` in order, the i-th task having the i-th part.
    The default writes text under ``path/stretch=i``, replacing what a run that failed has
    left there. A target that cannot replace, like a topic, has the failed stretch twice,
    and no other. A manifest of another version of the ordering, or of another number of
    stretches, is an error: its parts would not fit. ``stop_before`` leaves the stretches
    from that number on to a later run.
    """
    version, total = version_of(spark, stored)
    done = {row["stretch"]: row for row in committed(spark, path).collect()}
    if any(row["version"] != version or row["stretches"] != stretches for row in done.values()):
        raise RuntimeError(f"what is published in {path} is of another ordering or cut")
    written = []
    for i in range(stretches):
        first, last = i * total // stretches + 1, (i + 1) * total // stretches
        if i in done or (stop_before is not None and i >= stop_before):
            continue
        rows = read_stretch(spark, stored, first, last, tasks)
        if write is None:
            rows.select("raw").write.mode("overwrite").option("lineSep", "\n").text(f"{path}/stretch={i:06d}")
        else:
            write(rows, i)
        entry = spark.createDataFrame([(i, stretches, version, first, last)], ENTRY)
        entry.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
        written.append(i)
    return written


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """``pos, raw`` of the text of all stretches; an error if one is missing.

    A file's lines are numbered in the file; its first position is that of its stretch and
    of the files before it.
    """
    entries = committed(spark, path)
    known = sorted((row["stretch"], row["stretches"], row["first_pos"]) for row in entries.collect())
    if not known or [k[0] for k in known] != list(range(known[0][1])):
        raise RuntimeError(f"not all stretches of {path} are published")
    return read_ordered_lines(spark, f"{path}/stretch=*", f"{path}/read")
