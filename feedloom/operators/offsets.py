"""Which offsets of a feed are missing or come more than once.

Offsets are marked in bitmaps of ``BLOCK`` bits, one per partition and block, which every
task makes of its own rows before anything moves. Only bitmaps that are not full are looked
into, and single offsets are counted only in blocks with more rows than bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.numbers import floor_div
from feedloom.operators.sizing import join_summary, stored_rows

# Fixed value: the bits of the bitmaps that the built-in aggregate makes.
BLOCK = 32_768
MISSING, REPEATED = "missing", "repeated"


def _bytes(bits: Column) -> Column:
    """The bitmap as an array of its bytes, made once for all looks into it."""
    digits = F.hex(bits)
    return F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK // 8 - 1)),
        lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int"),
    )


def _runs(rows: DataFrame, wanted: bool) -> DataFrame:
    """partition, first, last: the longest stretches of set (or unset) bits from lo to hi.

    ``rows``: partition, block, bytes, lo, hi. Stretches end at blocks.
    """
    def is_wanted(i: Column) -> Column:
        byte = F.get("bytes", F.call_function("div", i, F.lit(8)).cast("int"))
        bit = F.call_function("shiftright", byte, (i % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
        return bit if wanted else ~bit

    places = F.sequence("lo", "hi")
    opens = F.filter(places, lambda i: is_wanted(i) & ((i == F.col("lo")) | ~is_wanted(i - 1)))
    closes = F.filter(places, lambda i: is_wanted(i) & ((i == F.col("hi")) | ~is_wanted(i + 1)))
    base = F.col("block") * BLOCK
    return rows.select(
        "partition", base.alias("base"), F.inline(F.arrays_zip(opens.alias("open"), closes.alias("close")))
    ).select(
        "partition", (F.col("base") + F.col("open")).alias("first"), (F.col("base") + F.col("close")).alias("last")
    )


def _joined(runs: DataFrame, kind: str) -> DataFrame:
    """Stretches that touch at the ends of blocks as one."""
    order = Window.partitionBy("partition").orderBy("first")
    apart = F.coalesce(F.col("first") != F.lag("last").over(order) + 1, F.lit(True))
    return (
        runs.withColumn("apart", apart.cast("int"))
        .withColumn("stretch", F.sum("apart").over(order))
        .groupBy("partition", "stretch")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select("partition", "first", "last", F.lit(kind).alias("kind"))
    )


def offset_gaps(feed: DataFrame) -> DataFrame:
    """partition, first, last, kind: offsets between a partition's first and last one that
    are ``missing``, and those that are ``repeated``, in stretches as long as can be.

    A missing partition is a partition like others. Rows without an offset have no place to
    miss or repeat.
    """
    block = floor_div(F.col("offset"), BLOCK)
    placed = feed.filter(F.col("offset").isNotNull()).select(
        "partition", block.alias("block"), F.pmod("offset", F.lit(BLOCK)).alias("bit")
    )
    bitmap = F.call_function("bitmap_construct_agg", F.col("bit"))
    blocks, _ = stored_rows(
        placed.groupBy("partition", "block").agg(
            F.count("*").alias("n"), bitmap.alias("bits"), F.min("bit").alias("least"), F.max("bit").alias("most")
        ),
        "offset-blocks",
    )
    sides = Window.partitionBy("partition").orderBy("block")
    seen = blocks.withColumns({
        "set": F.call_function("bitmap_count", F.col("bits")),
        "before": F.lag("block").over(sides),
        "after": F.lead("block").over(sides),
    }).withColumns({
        "lo": F.when(F.col("before").isNull(), F.col("least")).otherwise(F.lit(0)).cast("int"),
        "hi": F.when(F.col("after").isNull(), F.col("most")).otherwise(F.lit(BLOCK - 1)).cast("int"),
    })
    holes = seen.filter(F.col("set") <= F.col("hi") - F.col("lo")).withColumn("bytes", _bytes(F.col("bits")))
    between = seen.filter(F.col("block") > F.col("before") + 1).select(
        "partition", ((F.col("before") + 1) * BLOCK).alias("first"), (F.col("block") * BLOCK - 1).alias("last")
    )
    crowded = blocks.filter(F.col("n") > F.call_function("bitmap_count", F.col("bits"))).select("partition", "block")
    again = (
        join_summary(placed, crowded, ["partition", "block"], "left_semi")
        .groupBy("partition", "block", "bit").agg(F.count("*").alias("n")).filter("n > 1")
        .groupBy("partition", "block").agg(bitmap.alias("bits"))
        .select("partition", "block", _bytes(F.col("bits")).alias("bytes"),
                F.lit(0).alias("lo"), F.lit(BLOCK - 1).alias("hi"))
    )
    missing = _runs(holes, False).unionByName(between)
    return _joined(missing, MISSING).unionByName(_joined(_runs(again, True), REPEATED))
