"""Feeds and runs as files. Orderings are written by ``operators.ordering``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.contract import FEED_COLUMNS, sort_columns
from feedloom.operators.ordering import in_order, in_stretches
from feedloom.operators.runs import MARK_EVERY
from feedloom.operators.sizing import table_options


def write_feed(feed: DataFrame, path: str, records_per_file: int = 0) -> None:
    """Store a feed; with ``records_per_file`` no file holds more than that many rows."""
    (
        feed.select(*FEED_COLUMNS)
        .write.mode("overwrite")
        .options(**table_options("value", "offset"))
        .option("maxRecordsPerFile", records_per_file)
        .parquet(path)
    )


def write_lines(feed: DataFrame, path: str) -> None:
    """The bare lines of a feed as text, each ended by ``\\n``."""
    feed.select(F.coalesce("value", F.lit("")).alias("value")).write.mode("overwrite").option(
        "lineSep", "\n"
    ).text(path)


def write_ordered_lines(records: DataFrame, key: str, path: str, ranges: int | None = None) -> None:
    """The raw lines in the order of ``key`` as text; files in order of name, lines in order within."""
    sort_columns(key)
    in_order(records, key, ranges).select("raw").write.mode("overwrite").option(
        "lineSep", "\n"
    ).text(path)


def write_stored_lines(spark: SparkSession, stored: str, path: str, files: int) -> None:
    """The lines of a stored ordering as ``files`` texts of like length; files in order of
    name, lines in order within. Text cannot give back a record that contains a newline."""
    in_stretches(spark, stored, files).select("raw").write.mode("overwrite").option(
        "lineSep", "\n"
    ).text(path)


def write_runs(runs: DataFrame, path: str, every: int = MARK_EVERY) -> None:
    """Sorted runs under one folder per key and partition; every ``every``-th row is a mark.

    Marks are rows of the runs in files of their own, so a merge finds them without a pass
    over the others. ``sorted_runs`` leaves neighbouring runs only in each task, so nothing
    is shuffled here: the number of files is about that of the tasks times the keys, and a
    partition that holds a third of all rows is written by a third of the tasks.
    """
    if every < 1:
        raise ValueError("the step of marks must be positive")
    (
        runs.withColumn("mark", (F.col("pos_in_run") % every == 0).cast("int"))
        .sortWithinPartitions("key", "partition", "mark", "run", "pos_in_run")
        .write.mode("overwrite")
        .options(**table_options("raw", "offset", "pos_in_run"))
        .partitionBy("key", "partition", "mark")
        .parquet(path)
    )
