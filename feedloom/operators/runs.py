"""Sorted runs: each partition cut by arrival into short, sorted pieces, and their merge.

Every ``MARK_EVERY``-th row of a run is a mark: it stands for the rows since the mark
before. All marks in order, every q-th of them is a splitter, so between two splitters lie
at most ``q * MARK_EVERY`` rows that marks stand for, and of each run less than
``MARK_EVERY`` more. No row is sampled, and the bound holds whatever the keys are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from feedloom import scratch
from feedloom.contract import FLUSH_SIZE, SORT_KEYS, sort_columns
from feedloom.functions.numbers import floor_div
from feedloom.operators.arrival import CHUNK_OFFSETS, with_arrival_rank
from feedloom.operators.ordering import for_each_key, read_ordering, store_ordering, total
from feedloom.operators.ranges import key_of
from feedloom.operators.sizing import ranges_for

MARK_EVERY = 100


def sorted_runs(
    records: DataFrame,
    flush_size: int = FLUSH_SIZE,
    keys: tuple[str, ...] = SORT_KEYS,
    chunk_offsets: int = CHUNK_OFFSETS,
) -> DataFrame:
    """One row per key and record: its run and its place in the run.

    Only the line and the sort columns are moved. One range shuffle by ``(partition, run)``
    puts neighbouring runs in the same task, where all keys are sorted, and only then are
    the rows multiplied by the number of keys.
    """
    columns = dict.fromkeys(["raw", *[c for key in keys for c in sort_columns(key)]])
    run = floor_div(F.col("rank") - 1, flush_size)
    ranked = with_arrival_rank(records.select(*columns), chunk_offsets)
    placed = ranked.withColumn("run", run).drop("rank").repartitionByRange("partition", "run")
    for key in keys:
        order = Window.partitionBy("partition", "run").orderBy(*sort_columns(key))
        placed = placed.withColumn(f"_by_{key}", F.row_number().over(order).cast("bigint"))
    places = F.array(*[
        F.struct(F.lit(key).alias("key"), F.col(f"_by_{key}").alias("pos_in_run")) for key in keys
    ])
    return placed.select(F.inline(places), *columns, "run")


def splitters(marks: DataFrame, key: str, ranges: int) -> list[Row]:
    """Keys that cut marked runs into ``ranges`` ranges at most, in order.

    The marks are few and are put in order like any records; of them, only the splitters
    come to the driver, one for each range.
    """
    spark, path = marks.sparkSession, scratch.new_path(marks.sparkSession, f"marks-{key}")
    store_ordering(marks, key, path, ranges)
    step = -(-total(spark, path) // ranges) or 1
    chosen = read_ordering(spark, path).filter(F.col("pos") % step == 0).select("pos", key_of(key).alias("k")).collect()
    return [row["k"] for row in sorted(chosen, key=lambda row: row["pos"])]


def merge_stored(runs: DataFrame, key: str, path: str, ranges: int | None = None) -> None:
    """Merge stored runs into a stored ordering; ``runs`` has raw, the sort columns and mark.

    The runs' own marks say where ranges are cut. Rows go to their range by a search among
    the splitters and are sorted there.
    """
    sort_columns(key)
    if ranges is None:
        size = runs.agg(F.sum(F.octet_length("raw").cast("bigint"))).first()[0]
        ranges = ranges_for(size or 0)
    store_ordering(runs, key, path, bounds=splitters(runs.filter("mark = 1"), key, ranges))


def merge_all(runs: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Merge the stored runs of each key into an ordering of its own; returns where."""
    paths = {key: f"{path}/key={key}" for key in runs}
    for_each_key(lambda key: merge_stored(runs[key], key, paths[key]), runs)
    return paths
