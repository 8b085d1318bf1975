"""Feeds and lines in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.contract import FEED_COLUMNS, FEED_SCHEMA
from feedloom.operators.sizing import stored_rows


def as_feed(rows: DataFrame) -> DataFrame:
    """Rows with the feed's columns under its types; other columns are not read."""
    return rows.select(
        F.col("value").cast("string").alias("value"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )


def scan_feed(spark: SparkSession, path: str) -> DataFrame:
    """Every row of every partition of a feed stored as parquet."""
    return as_feed(spark.read.parquet(path).select(*FEED_COLUMNS))


def stream_feed(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same feed as a stream, some files per micro-batch."""
    return as_feed(
        spark.readStream.schema(FEED_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: split at ``\\n`` only, one final ``\\r`` taken off.

    The reader's own line separator also splits at a lone ``\\r`` and so would
    tear a record in two.
    """
    lines = _raw_lines(spark, path)
    bare = F.regexp_replace("value", r"\r\z", "")
    return lines.select(F.when(F.col("value").endswith("\r"), bare).otherwise(F.col("value")).alias("line"))


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def lines_feed(spark: SparkSession, path: str, store: str) -> DataFrame:
    """Text lines as a feed, stored in ``store`` with a place for each.

    A line's partition is the number of its file in the order of names, its offset the
    number of the line in the file. Neither depends on how files are split into tasks.
    """
    splits = _store_splits(spark, path, f"{store}/lines")
    inside = Window.partitionBy("file").orderBy("block")
    number = F.dense_rank().over(Window.orderBy("file")) - 1
    starts, _ = stored_rows(splits.select(
        "file", "block", number.alias("partition"), (F.sum("n").over(inside) - F.col("n") - F.col("first")).alias("start")
    ), "line-splits")
    lines = spark.read.parquet(f"{store}/lines").join(starts, ["file", "block"])
    bare = F.regexp_replace("raw", r"\r\z", "")
    return as_feed(lines.select(
        F.when(F.col("raw").endswith("\r"), bare).otherwise(F.col("raw")).alias("value"),
        "partition", (F.col("start") + F.col("row")).alias("offset"), F.lit(None).alias("timestamp"),
    ))


def _store_splits(spark: SparkSession, path: str, store: str) -> DataFrame:
    """Lines stored with the split of the file they come from and their row in its task.

    Returns a row per split, far fewer than lines: file, block, n, and the first row.
    """
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row")
    _raw_lines(spark, path).select(F.col("value").alias("raw"), *split, row).write.mode("overwrite").parquet(store)
    rows = spark.read.parquet(store)
    return rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))


def read_ordered_lines(spark: SparkSession, path: str, store: str) -> DataFrame:
    """``pos, raw`` of texts whose order is that of file paths and of lines within.

    The lines are stored in ``store`` first. One window runs over the splits of the files.
    """
    splits = _store_splits(spark, path, store)
    before = F.sum("n").over(Window.orderBy("file", "block")) - F.col("n")
    start = splits.select("file", "block", (before - F.col("first") + 1).alias("start"))
    pos = (F.col("start") + F.col("row")).cast("bigint")
    return spark.read.parquet(store).join(start, ["file", "block"]).select(pos.alias("pos"), "raw")
