"""Arrival order: ranks within each feed partition, and what depends on them.

A feed has few partitions and one may hold a third of all rows, so a window per
partition would put billions of rows in one task. Ranks are therefore counted in
two levels: a window inside each chunk of ``CHUNK_OFFSETS`` consecutive offsets,
plus the number of rows in the chunks before it, which comes from a histogram: one row
per chunk, counted once and stored, and joined as its size allows.

A row without a partition is in a partition of such rows; rows without an offset arrive
before all others of their partition. Rows at the same place follow each other by line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.contract import BATCH_SIZE
from feedloom.functions.numbers import floor_div
from feedloom.operators.sizing import join_summary, stored_rows

CHUNK_OFFSETS = 1_000_000
_CHUNK = ["partition", "chunk"]


def _chunk(chunk_offsets: int):
    return floor_div(F.col("offset"), chunk_offsets).alias("chunk")


def histogram(rows: DataFrame, chunk_offsets: int = CHUNK_OFFSETS) -> DataFrame:
    """partition, chunk, in_chunk; before: rows of the partition in earlier chunks; in_partition.

    One scan of the rows. It is stored, so all that is made of it agrees.
    """
    whole = Window.partitionBy("partition")
    earlier = whole.orderBy("chunk")
    counted = (
        rows.groupBy("partition", _chunk(chunk_offsets)).agg(F.count("*").alias("in_chunk"))
        .withColumn("before", F.sum("in_chunk").over(earlier) - F.col("in_chunk"))
        .withColumn("in_partition", F.sum("in_chunk").over(whole))
    )
    return stored_rows(counted, "histogram")[0]


def with_arrival_rank(
    rows: DataFrame, chunk_offsets: int = CHUNK_OFFSETS, counted: DataFrame | None = None
) -> DataFrame:
    """Add ``rank``, the 1-based arrival number within the partition.

    ``counted`` is the histogram of the rows if it is known already; rows may be part of
    those it counts if all of a chunk are there.
    """
    counted = histogram(rows, chunk_offsets) if counted is None else counted
    line = [F.col(c) for c in ("value", "raw") if c in rows.columns]
    inside = Window.partitionBy(*_CHUNK).orderBy("offset", *line)
    placed = join_summary(
        rows.withColumn("chunk", _chunk(chunk_offsets)), counted.select(*_CHUNK, F.col("before").alias("_before")), _CHUNK
    )
    rank = (F.col("_before") + F.row_number().over(inside)).cast("bigint")
    return placed.withColumn("rank", rank).select(*rows.columns, "rank")


def cap_per_partition(
    records: DataFrame, n: int, chunk_offsets: int = CHUNK_OFFSETS
) -> DataFrame:
    """The first ``n`` records of each partition in arrival order; 0 means all."""
    if n < 0:
        raise ValueError("the cap must not be negative")
    if n == 0:
        return records
    return _first(records, n, chunk_offsets, histogram(records, chunk_offsets)).select(*records.columns)


def _first(records: DataFrame, n: int, chunk_offsets: int, counted: DataFrame) -> DataFrame:
    """The first ``n`` of each partition; only chunks that begin before the cut are ranked."""
    begun = counted.filter(F.col("before") < n).select(*_CHUNK)
    near = join_summary(records.withColumn("chunk", _chunk(chunk_offsets)), begun, _CHUNK, "left_semi")
    return with_arrival_rank(near.drop("chunk"), chunk_offsets, counted).filter(F.col("rank") <= n)


def expected_count(
    records: DataFrame, expected: int, chunk_offsets: int = CHUNK_OFFSETS
) -> DataFrame:
    """Stop each partition at ``expected`` records and say whether it got there."""
    if expected < 1:
        raise ValueError("the expected count must be positive")
    counted = histogram(records, chunk_offsets)
    arrived = counted.groupBy("partition").agg((F.max("in_partition") >= expected).alias("complete"))
    kept = _first(records, expected, chunk_offsets, counted)
    return join_summary(kept, arrived, ["partition"]).select(*records.columns, "complete")


def fixed_batches(
    rows: DataFrame, batch_size: int = BATCH_SIZE, chunk_offsets: int = CHUNK_OFFSETS
) -> DataFrame:
    """Group each partition in arrival order into batches; the last may be short."""
    before = F.col("rank") - 1
    return (
        with_arrival_rank(rows, chunk_offsets)
        .withColumn("batch", floor_div(before, batch_size))
        .withColumn("slot", (before % batch_size).cast("bigint"))
        .drop("rank")
    )


def milestones(
    records: DataFrame, every: int, chunk_offsets: int = CHUNK_OFFSETS
) -> DataFrame:
    """When each partition reached each multiple of ``every`` records, and how fast.

    The rate is counted from the first record and NULL if no time has passed.
    """
    if every < 1:
        raise ValueError("the milestone step must be positive")
    narrow = records.select("partition", "offset", "timestamp")
    started = narrow.groupBy("partition").agg(F.min("timestamp").alias("started"))
    reached = with_arrival_rank(narrow, chunk_offsets).filter(F.col("rank") % every == 0)
    seconds = (F.unix_micros("timestamp") - F.unix_micros("started")) / F.lit(1e6)
    return join_summary(reached, stored_rows(started, "started")[0], ["partition"]).select(
        "partition",
        F.col("rank").alias("records"),
        F.col("timestamp").alias("reached_at"),
        F.when(seconds > 0, F.col("rank") / seconds).alias("rate"),
    )
