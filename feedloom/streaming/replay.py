"""Drains of feeds whose rows may come again: a place counts once.

Within the watermark, state per place drops what was seen already. State is bounded by the
lateness, so a row that comes again after that passes it. ``read_distinct`` is the exact rule
for what was stored: of rows at one place, the one of the first batch stays, of several in
one batch the one with the smallest line. Rows without a partition or an offset have no
place to come again to, and all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.intake import parse_feed
from feedloom.streaming.drain import drain

def distinct_places(feed: DataFrame, lateness: str) -> DataFrame:
    """A streaming feed without rows whose place came before, as far as the watermark knows."""
    placed = feed.filter("partition is not null and offset is not null").withWatermark("timestamp", lateness)
    once = placed.dropDuplicatesWithinWatermark(["partition", "offset"])
    return once.unionByName(feed.filter("partition is null or offset is null"))


def drain_distinct(feed: DataFrame, path: str, checkpoint: str, lateness: str) -> None:
    """Parse all that a stream holds into ``path``, places that come again left out."""

    def store(batch: DataFrame, number: int) -> None:
        parse_feed(batch).write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    drain(distinct_places(feed, lateness), store, checkpoint)


def read_distinct(spark: SparkSession, path: str) -> DataFrame:
    """Stored parsed rows, every place once. Tasks reduce their own rows first."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c != "batch_id"]
    first = F.min(F.struct("batch_id", *columns)).alias("first")
    placed = rows.filter("partition is not null and offset is not null").groupBy("partition", "offset").agg(first)
    others = rows.filter("partition is null or offset is null").select(*columns)
    return placed.select("first.*").select(*columns).unionByName(others)
