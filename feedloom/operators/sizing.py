"""Sizes of sorts, stored summaries and their joins, table formats."""

from __future__ import annotations

from functools import reduce
from math import ceil, sqrt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedloom import scratch

# A sort of so many MB of lines has this times its square root of ranges: both the number
# of ranges and their size grow with the input. 1 GB is cut into 128 ranges of 8 MB, 1 TB
# into 4,096 of 256 MB, 100 TB into 40,960 of 2.5 GB, which sort with spills in a few GB
# of memory, and of which the driver can hold the bounds.
RANGES_PER_ROOT_MB = 4


def ranges_for(raw_bytes: int) -> int:
    """How many ranges a sort of ``raw_bytes`` gets."""
    return max(1, ceil(RANGES_PER_ROOT_MB * sqrt(raw_bytes / 1024**2)))


def rows_per_file(rows: int, least: int, files: int) -> int:
    """Rows a file of a stream holds at most: ``least``, and more where ``rows`` would make
    more than ``files`` files of them.

    A micro-batch costs its time however few rows it has, so a feed in files of a fixed number
    of rows, some files per micro-batch, takes a time that its rows alone do not need.
    """
    if least < 1 or files < 1:
        raise ValueError("a file needs a row, and rows need a file")
    return max(least, -(-rows // files))


def stored_rows(rows: DataFrame, label: str, sizes: dict | None = None, **options: str) -> tuple[DataFrame, dict]:
    """Rows written once to the shared folder and read from there, and what was counted meanwhile.

    Later steps then agree on the rows, and none makes them again. ``sizes``: aggregates
    by name, taken while the rows are written.
    """
    spark, path = rows.sparkSession, scratch.new_path(rows.sparkSession, label)
    wanted = [aggregate.alias(name) for name, aggregate in (sizes or {}).items()]
    seen = Observation(label)
    watched = rows.observe(seen, *wanted) if wanted else rows
    watched.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path), seen.get if wanted else {}


def join_summary(rows: DataFrame, summary: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Rows beside the row of a stored summary with the same ``on``, a NULL being a value like others.

    A stored summary has a known size, by which Catalyst decides whether to broadcast it.
    """
    other = summary.withColumnsRenamed({c: f"_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    return rows.join(other, same, how).drop(*[f"_{c}" for c in on])


def table_options(*distinct: str) -> dict[str, str]:
    """Parquet options; nearly all values of the ``distinct`` columns are new, so a
    dictionary of them would be wasted work."""
    return {
        "compression": "snappy",
        **{f"parquet.enable.dictionary#{column}": "false" for column in distinct},
    }
