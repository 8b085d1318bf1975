"""Throughput of a running stream: records per interval, late ones counted apart.

The feed is read once. Each micro-batch is reduced to a row per interval (records, latest
moment), and these rows are a stream of their own, one former micro-batch at a time, for
the windows of the engine: an interval comes out when the watermark has passed its end, and
what comes for it after that is late. All records of one micro-batch and interval are late
together, so reducing first changes nothing, and the state is a number per open interval.

A micro-batch that runs again replaces its rows. ``read_throughput`` puts together what
arrived and what the windows gave, so no record is in neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.numbers import floor_div
from feedloom.operators.intake import valid_records
from feedloom.streaming.drain import drain

_ARRIVED = "interval_no BIGINT, records BIGINT, moment TIMESTAMP"
_COUNTED = "interval_no BIGINT, records BIGINT"


def _number(moment, start, interval_seconds: int):
    return floor_div(F.unix_micros(moment) - F.unix_micros(start), interval_seconds * 1_000_000)


def windowed_counts(arrived: DataFrame, interval_seconds: int, start: str, lateness_seconds: int) -> DataFrame:
    """``interval_no, records`` of a streaming ``interval_no, records, moment``, closed intervals only.

    ``start``: the moment at which interval 0 begins, as text.
    """
    first = F.lit(start).cast("timestamp")
    # Windows begin at multiples of their length after the epoch, moved by what ``start`` is off.
    micros = arrived.sparkSession.range(1).select(F.unix_micros(first)).first()[0]
    moved = micros % (interval_seconds * 1_000_000)
    spell = F.window(
        "moment", f"{interval_seconds} seconds", startTime=f"{moved} microseconds" if moved else None
    )
    return (
        arrived.withWatermark("moment", f"{lateness_seconds} seconds")
        .groupBy(spell.alias("spell")).agg(F.sum("records").alias("records"))
        .select(_number("spell.start", first, interval_seconds).alias("interval_no"), "records")
    )


def drain_throughput(
    feed: DataFrame, path: str, checkpoint: str, interval_seconds: int, start: str, lateness_seconds: int = 0
) -> None:
    """Count the valid records of all that a stream holds, then stop; a later call goes on.

    ``path/arrived`` gets the rows per micro-batch, ``path/counted`` the closed intervals.
    """
    if interval_seconds < 1 or lateness_seconds < 0:
        raise ValueError("the interval must be positive, and lateness not negative")
    spark, first = feed.sparkSession, F.lit(start).cast("timestamp")

    def arrive(batch: DataFrame, number: int) -> None:
        counts = valid_records(batch).groupBy(_number("timestamp", first, interval_seconds).alias("interval_no")).agg(
            F.count("*").alias("records"), F.max("timestamp").alias("moment")
        )
        # One file of a row per interval, which is one micro-batch of the windows.
        counts.repartition(1).write.mode("overwrite").parquet(f"{path}/arrived/batch_id={number}")

    def count(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/counted/batch_id={number}")

    drain(feed, arrive, f"{checkpoint}/arrived")
    arrived = (
        spark.readStream.schema(_ARRIVED).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True).parquet(f"{path}/arrived")
    )
    drain(windowed_counts(arrived, interval_seconds, start, lateness_seconds), count, f"{checkpoint}/counted")


def read_throughput(
    spark: SparkSession, path: str, interval_seconds: int, start: str, lateness_seconds: int = 0
) -> DataFrame:
    """``interval_no, records, late, closed``: an interval's records in time, those that came
    too late, and whether it is over. Records without a timestamp are in one row of their own,
    neither in time nor late, whose ``interval_no`` and ``closed`` are NULL."""
    stored = spark.read.option("recursiveFileLookup", True)
    arrived = stored.schema(_ARRIVED).parquet(f"{path}/arrived")
    counted = stored.schema(_COUNTED).parquet(f"{path}/counted").withColumnRenamed("records", "in_time")
    first = F.lit(start).cast("timestamp")
    # The watermark is in whole milliseconds.
    passed = arrived.agg((F.unix_millis(F.max("moment")) * 1000 - lateness_seconds * 1_000_000).alias("passed"))
    end = F.unix_micros(first) + (F.col("interval_no") + 1) * (interval_seconds * 1_000_000)
    over = F.col("in_time").isNotNull() | (end <= F.col("passed"))
    in_time = F.when(over, F.coalesce("in_time", F.lit(0))).otherwise(F.col("came")).cast("bigint")
    return (
        arrived.groupBy("interval_no").agg(F.sum("records").alias("came"))
        .join(counted, "interval_no", "left")
        .join(F.broadcast(passed), how="cross")  # one row
        .select("interval_no", in_time.alias("records"), (F.col("came") - in_time).alias("late"), over.alias("closed"))
    )
