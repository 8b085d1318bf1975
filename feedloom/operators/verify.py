"""Checks of stored orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.contract import HEAD_SIZE, sort_columns
from feedloom.functions.numbers import floor_div

CHUNK_POSITIONS = 1_000_000


def sortedness(
    rows: DataFrame,
    key: str,
    position: str = "pos",
    within: tuple[str, ...] = (),
    chunk: Column | None = None,
    numbers: bool = False,
) -> DataFrame:
    """One row: rows, places where the key falls, and the first position of one.

    The order checked is the stored ``position``, separately for each value of
    ``within``. Neighbours are compared inside chunks of consecutive positions;
    the last key of a chunk meets the first of the next in a table with one row
    per chunk. ``chunk`` may name any cut of the order into such pieces. Equal
    neighbours are in order. With ``numbers``, ``is_numbered`` says whether the positions
    are 1, 2, ... without a gap or a repeat; that is for an order without ``within``.
    """
    sort_columns(key)
    if chunk is None:
        chunk = floor_div(F.col(position), CHUNK_POSITIONS)
    place, groups = F.col(position), list(within)
    narrow = rows.select(
        *groups, place.alias("at"), F.col(key).alias("k"),
        chunk.alias("chunk"),
    )
    inside = Window.partitionBy(*groups, "chunk").orderBy("at")
    per_chunk = (
        narrow.withColumns({
            "falls": F.lag("k").over(inside) > F.col("k"),
            "repeats": F.lag("at").over(inside) == F.col("at"),
            "opens": F.lag("at").over(inside).isNull(),
            "closes": F.lead("at").over(inside).isNull(),
        })
        .groupBy(*groups, "chunk")
        .agg(
            F.count("*").alias("n"),
            F.count_if("falls").alias("falls"),
            F.min(F.when(F.col("falls"), F.col("at"))).alias("first_fall"),
            F.count_if("repeats").alias("repeats"),
            F.min("at").alias("start"),
            F.max("at").alias("end"),
            F.max(F.when(F.col("opens"), F.col("k"))).alias("first_key"),
            F.max(F.when(F.col("closes"), F.col("k"))).alias("last_key"),
        )
    )
    chunks = Window.partitionBy(*groups).orderBy("chunk")
    seam = F.lag("last_key").over(chunks) > F.col("first_key")
    overlap = F.lag("end").over(chunks) >= F.col("start")
    numbered = (F.min("start") == 1) & (F.max("end") == F.sum("n")) & (
        F.sum(F.col("repeats") + F.col("overlap").cast("int")) == 0
    )
    checked = (
        per_chunk.withColumn("seam", F.coalesce(seam, F.lit(False)))
        .withColumn("overlap", F.coalesce(overlap, F.lit(False)))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce(F.sum(F.col("falls") + F.col("seam").cast("int")), F.lit(0))
            .cast("bigint").alias("inversions"),
            F.min(F.least("first_fall", F.when(F.col("seam"), F.col("start"))))
            .alias("first_bad_pos"),
            F.coalesce(numbered, F.lit(True)).alias("is_numbered"),
        )
        .withColumn("is_sorted", F.col("inversions") == 0)
    )
    shown = ["rows", "inversions", "first_bad_pos", "is_sorted"]
    return checked.select(*shown, *["is_numbered"] * numbers)


def check_head(head: DataFrame, key: str, n: int = HEAD_SIZE) -> DataFrame:
    """One row: are the first ``n`` rows of a stored order in order?"""
    checked = sortedness(head.filter(F.col("pos") <= n), key)
    return checked.select(
        F.lit(key).alias("key"),
        F.col("rows").alias("checked"),
        F.when(F.col("rows") < 2, "not enough data")
        .when(F.col("is_sorted"), "sorted")
        .otherwise("not sorted")
        .alias("status"),
    )
