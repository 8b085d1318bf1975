"""Take in all that a stream holds, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.contract import SORT_KEYS, sort_columns
from feedloom.operators.intake import parse_feed, valid_records
from feedloom.operators.ordering import ROW_MASK
from feedloom.operators.runs import MARK_EVERY, merge_all
from feedloom.operators.sizing import table_options


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def drain_feed(feed: DataFrame, path: str, checkpoint: str) -> None:
    """Parse everything in the stream into ``path``, then stop.

    Each micro-batch overwrites a folder of its own number, so one that is run
    again after a failure replaces its rows instead of doubling them. The parser is a
    part of the stream's plan: building it anew for each micro-batch took a third of
    the time of a small one.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").options(**table_options("raw", "offset")).parquet(
            _batch_folder(path, batch_id)
        )

    drain(parse_feed(feed), store, checkpoint)


def drain_runs(
    feed: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = SORT_KEYS, every: int = MARK_EVERY
) -> None:
    """Store each micro-batch as sorted runs for every key, then stop.

    A run is the share of a micro-batch in one task, sorted where it is: nothing
    is shuffled before the final merge. The batch is parsed once, into a table; each
    ``every``-th row of a run is a mark, as ``write_runs`` makes them.
    """
    for key in keys:
        sort_columns(key)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, parsed = batch.sparkSession, _batch_folder(f"{path}/parsed", batch_id)
        valid_records(batch).drop("address").write.mode("overwrite").parquet(parsed)
        place = F.monotonically_increasing_id().bitwiseAND(ROW_MASK) + 1
        for key in keys:
            columns = list(dict.fromkeys(["raw", *sort_columns(key)]))
            runs = spark.read.parquet(parsed).select(*columns).sortWithinPartitions(*sort_columns(key))
            (
                runs.withColumn("mark", (place % every == 0).cast("int")).write.mode("overwrite").partitionBy("mark")
                .parquet(_batch_folder(f"{path}/key={key}", batch_id))
            )

    drain(feed, store, checkpoint)


def drain(feed: DataFrame, store, checkpoint: str) -> None:
    """Give all that the stream holds to ``store(rows, batch number)``, then stop."""
    # A stream without rows has no micro-batch; this one gives its table a schema.
    store(feed.sparkSession.createDataFrame([], feed.schema), -1)
    query = (
        feed.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches stored under ``path``."""
    return spark.read.parquet(path).drop("batch_id")


def stream_sort(feed: DataFrame, path: str, keys: tuple[str, ...] = SORT_KEYS) -> dict[str, str]:
    """Sorted runs from a stream, then one merge of them per key; returns the orderings' paths."""
    spark = feed.sparkSession
    drain_runs(feed, f"{path}/runs", f"{path}/offsets", keys)
    return merge_all({key: read_batches(spark, f"{path}/runs/key={key}") for key in keys}, path)


def intake_sessions(feed: DataFrame, idle_seconds: int, lateness: str = "0 seconds") -> DataFrame:
    """For a stream that never ends: the spells of intake between silences, per partition.

    The first session of a partition ends where its intake would be cut. A session
    comes out once the watermark has passed its end, so open ones are not shown.
    Start the query with ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
    on: rows are then merged into sessions before the shuffle, and a heavy partition
    costs its task only a few of them.
    """
    return (
        valid_records(feed)
        .withWatermark("timestamp", lateness)
        .groupBy("partition", F.session_window("timestamp", f"{idle_seconds} seconds").alias("spell"))
        .agg(F.count("*").alias("records"))
        .select(
            "partition",
            F.col("spell.start").alias("first_at"),
            (F.col("spell.end") - F.make_dt_interval(secs=F.lit(float(idle_seconds)))).alias("last_at"),
            "records",
        )
    )
