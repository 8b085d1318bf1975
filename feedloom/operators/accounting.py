"""Counts, rates and reconciliations of a feed. All aggregate before they shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom import scratch
from feedloom.contract import BAD_ID, MISSING_FIELD_1, MISSING_FIELD_2, MISSING_FIELD_3
from feedloom.functions.lines import fingerprint
from feedloom.functions.numbers import floor_div
from feedloom.operators.sizing import join_summary, stored_rows


def intake_stats(parsed: DataFrame) -> DataFrame:
    """Per partition: messages, valid records, and malformed ones by reason."""
    error = F.col("error")
    return parsed.groupBy("partition").agg(
        F.count("*").alias("messages"),
        F.count_if(error.isNull()).alias("valid"),
        F.count("error").alias("malformed"),
        F.count_if(error == MISSING_FIELD_1).alias("missing_field_1"),
        F.count_if(error == MISSING_FIELD_2).alias("missing_field_2"),
        F.count_if(error == MISSING_FIELD_3).alias("missing_field_3"),
        F.count_if(error == BAD_ID).alias("bad_id"),
    )


def topic_size(feed: DataFrame) -> DataFrame:
    """Per partition: number of messages and the offset the next one would get."""
    return feed.groupBy("partition").agg(
        F.count("*").alias("messages"), (F.max("offset") + 1).alias("end_offset")
    )


#: Intervals that one task sums up; the sums before it come from a row per such chunk.
CHUNK_INTERVALS = 1 << 16


def throughput(rows: DataFrame, interval_seconds: int, start) -> DataFrame:
    """Progress at the end of every interval from ``start`` on, quiet ones included.

    ``start`` is a timestamp column expression. Rows before it are in intervals with
    negative numbers, which have no average rate. Rows without a timestamp are in one
    row of their own, with nothing but their count. Rows are counted per interval
    first and these counts stored; of them, only the first and last number come to the
    driver, and running totals are made in chunks of intervals, so that a far timestamp
    makes many rows but no large task.
    """
    spark = rows.sparkSession
    micros = F.unix_micros("timestamp") - F.unix_micros(start)
    number = floor_div(micros, interval_seconds * 1_000_000)
    path = scratch.new_path(spark, "throughput")
    rows.groupBy(number.alias("interval_no")).agg(F.count("*").alias("records")).write.parquet(path)
    counted = spark.read.schema("interval_no BIGINT, records BIGINT").parquet(path)
    first, last = counted.agg(F.min("interval_no"), F.max("interval_no")).first()
    spine = spark.range(0 if first is None else min(0, first), 0 if last is None else max(0, last + 1))
    chunk = floor_div(F.col("interval_no"), CHUNK_INTERVALS).alias("chunk")
    filled = (
        spine.withColumnRenamed("id", "interval_no").join(counted, "interval_no", "left")
        .select("interval_no", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"), chunk)
    )
    before = F.sum("n").over(Window.orderBy("chunk")) - F.col("n")
    chunks = filled.groupBy("chunk").agg(F.sum("records").alias("n")).select(
        "chunk", before.alias("before")
    )
    within = F.sum("records").over(Window.partitionBy("chunk").orderBy("interval_no"))
    elapsed = (F.col("interval_no") + 1) * interval_seconds
    columns = (
        "interval_no",
        "records",
        F.col("records_so_far").cast("bigint").alias("records_so_far"),
        F.when(F.col("records_so_far").isNotNull(), F.col("records") / F.lit(interval_seconds))
        .alias("current_rate"),
        F.when(elapsed > 0, F.col("records_so_far") / elapsed).alias("average_rate"),
    )
    dated = filled.withColumn("so_far", within).join(chunks, "chunk").withColumn(
        "records_so_far", F.col("so_far") + F.col("before")
    )
    undated = counted.where("interval_no is null").withColumn(
        "records_so_far", F.lit(None).cast("bigint")
    )
    return dated.select(*columns).unionByName(undated.select(*columns))


def completion_summary(rows: DataFrame, target: int) -> DataFrame:
    """One row: how much of the target has arrived, and how fast."""
    if target < 1:
        raise ValueError("the target must be positive")
    elapsed = (F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(1e6)
    return rows.agg(F.count("*").alias("sent"), elapsed.alias("elapsed_seconds")).select(
        "sent",
        F.lit(target).cast("bigint").alias("target"),
        (F.col("sent") / F.lit(float(target)) * 100).alias("completion_percent"),
        "elapsed_seconds",
        F.when(F.col("elapsed_seconds") > 0, F.col("sent") / F.col("elapsed_seconds")).alias("rate"),
        (F.col("sent") < target).alias("short_of_target"),
    )


def reconcile(produced: DataFrame, delivered: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per key: are the delivered lines exactly the produced ones?

    ``produced`` has ``raw``, ``delivered`` has ``key, raw``. Equal counts do not
    rule out a swap of one line for another, the fingerprints do.
    """
    totals = (F.count("*").cast("bigint"), fingerprint(F.col("raw")))
    made = produced.agg(totals[0].alias("produced"), totals[1].alias("made_print")).select(
        "*", F.explode(F.array(*[F.lit(key) for key in keys])).alias("key")
    )
    came = delivered.groupBy("key").agg(totals[0].alias("delivered"), totals[1].alias("came_print"))
    none = F.lit(0).cast("bigint")
    return made.join(came, "key", "full").select(
        "key",
        F.coalesce("produced", none).alias("produced"),
        F.coalesce("delivered", none).alias("delivered"),
        (F.coalesce("produced", none) == F.coalesce("delivered", none)).alias("counts_match"),
        (
            (F.coalesce("produced", none) == F.coalesce("delivered", none))
            & F.coalesce(F.col("made_print") == F.col("came_print"), F.lit(False))
        ).alias("contents_match"),
    )


def liveness(records: DataFrame, as_of, idle_seconds: int) -> DataFrame:
    """Per partition: the last valid record, seen from the moment ``as_of``."""
    idle = (F.unix_micros(as_of) - F.unix_micros(F.max("timestamp"))) / F.lit(1e6)
    return records.groupBy("partition").agg(
        F.count("*").alias("valid"),
        F.max("timestamp").alias("last_valid_at"),
        idle.alias("idle_seconds"),
        (idle <= idle_seconds).alias("alive"),
    )


def idle_cuts(records: DataFrame, idle_seconds: int) -> DataFrame:
    """Per partition with a silence longer than the timeout: when it goes on after it.

    Rows are reduced to the first and last moment per time slot of the length of
    the timeout. No silence inside one slot can be longer than the slot, so only
    neighbouring slots need comparing, and no row is sorted.
    """
    limit = idle_seconds * 1_000_000
    micros = F.unix_micros("timestamp")
    slots = records.groupBy(
        "partition", floor_div(micros, limit).alias("slot")
    ).agg(F.min(micros).alias("first"), F.max(micros).alias("last"))
    previous = F.lag("last").over(Window.partitionBy("partition").orderBy("slot"))
    return (
        slots.withColumn("silence", F.col("first") - previous)
        .filter(F.col("silence") > limit)
        .groupBy("partition")
        .agg(F.min("first").alias("cut_micros"))
    )


def idle_cut(records: DataFrame, idle_seconds: int) -> DataFrame:
    """The records of each partition before its first silence longer than the timeout.

    A record without a timestamp says nothing about silences and stays.
    """
    cuts = stored_rows(idle_cuts(records, idle_seconds), "idle-cuts")[0]
    before_cut = F.coalesce(F.unix_micros("timestamp") < F.col("cut_micros"), F.lit(True))
    return (
        join_summary(records, cuts, ["partition"], "left")
        .filter(before_cut)
        .select(*records.columns)
    )
