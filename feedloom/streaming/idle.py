"""The idle cut of a running stream: state per partition and event-time timers.

A partition's intake is a chain of valid records with no silence between them longer than
the timeout. A record within the timeout of the chain's end is let through at once and moves
the end. One beyond it waits: another record may still come between. Once the watermark has
passed the end by more than the timeout, nothing can, and the partition is closed: what
waits, and all that comes later, is cut. Only valid records move the end, while the
watermark also moves with malformed ones and with other partitions.

Records may come out of order by ``lateness_seconds``; with more than none, a partition's
first records wait until the watermark has passed them, as an earlier one would open the
chain. What is later than that is left out by the engine, which counts it in the progress of
the query (``numRowsDroppedByWatermark``). A record without a timestamp says nothing about
silences and passes; one without a partition is in a partition of such records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedloom.operators.intake import parse_feed, valid_records
from feedloom.streaming.drain import drain

_STORE = "spark.sql.streaming.stateStore.providerClass"
_KEYED_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_ROW = ["partition", "offset", "raw", "micros"]
_ROW_KINDS = "partition INT, offset BIGINT, raw BINARY, micros BIGINT"
_OUT = f"{_ROW_KINDS}, closed BOOLEAN"


def _plain(row) -> tuple:
    """A row with whole numbers, none made a float by a missing one beside it."""
    partition, offset, raw, micros = row
    return tuple(None if pd.isna(v) else int(v) for v in (partition, offset)) + (
        None if raw is None else bytes(raw), None if pd.isna(micros) else int(micros)
    )


class _Chain(StatefulProcessor):
    """One partition. State: the chain's end, its timer, and the records that wait."""

    def __init__(self, idle_seconds: int, lateness_seconds: int):
        self.idle, self.in_order = idle_seconds * 1_000_000, lateness_seconds == 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chain = handle.getValueState("chain", "last BIGINT, timer BIGINT, closed BOOLEAN")
        self.waiting = handle.getListState("waiting", _ROW_KINDS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = [_plain(row) for part in rows for row in part[_ROW].itertuples(index=False, name=None)]
        came = [row for row in came if row[2] is not None]
        yield from self._out([row for row in came if row[3] is None])
        yield from self._go_on([row for row in came if row[3] is not None], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._go_on([], timerValues)

    def close(self) -> None:
        pass

    def _go_on(self, came: list[tuple], timer_values) -> Iterator[pd.DataFrame]:
        last, timer, closed = self.chain.get() if self.chain.exists() else (None, None, False)
        if closed:
            return
        waiting = sorted([tuple(r) for r in self.waiting.get()] + came, key=lambda r: (r[3], r[1] is not None, r[1]))
        watermark = timer_values.getCurrentWatermarkInMs() * 1000
        if waiting and last is None and (self.in_order or watermark >= waiting[0][3]):
            last = waiting[0][3]
        n = 0
        while last is not None and n < len(waiting) and waiting[n][3] - last <= self.idle:
            last, n = max(last, waiting[n][3]), n + 1
        yield from self._out(waiting[:n])
        waiting = waiting[n:]
        if last is not None and watermark > last + self.idle:
            self.waiting.clear()
            self.chain.update((last, timer, True))
            yield from self._out([(None, None, None, last)], closed=True)
            return
        # Wake up when the chain can open, or when nothing can lengthen it any more.
        wake = waiting[0][3] if last is None and waiting else last + self.idle if last is not None else None
        wake = None if wake is None else wake // 1000 + 1
        if wake != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wake is not None:
                self.handle.registerTimer(wake)
        self.waiting.put(waiting) if waiting else self.waiting.clear()
        self.chain.update((last, wake, False))

    def _out(self, rows: list[tuple], closed: bool = False) -> Iterator[pd.DataFrame]:
        if rows:
            columns = list(zip(*rows, strict=True))
            frame = pd.DataFrame({
                name: pd.array(column, "Int64") if name != "raw" else list(column)
                for name, column in zip(_ROW, columns, strict=True)
            })
            frame["partition"] = frame["partition"].astype("Int32")
            yield frame.assign(closed=closed)


def idle_cut_stream(feed: DataFrame, idle_seconds: int, lateness_seconds: int = 0) -> DataFrame:
    """``partition, offset, raw, micros, closed`` of a streaming feed.

    Rows with ``closed`` false are records before their partition's cut, the line as bytes.
    One row with ``closed`` true tells that a partition is closed, and its last moment; its
    line is NULL, and its partition is in no column, so it is counted, not joined.
    """
    if idle_seconds < 1 or lateness_seconds < 0:
        raise ValueError("the timeout must be positive, and lateness not negative")
    timed = feed.withWatermark("timestamp", f"{lateness_seconds} seconds")
    # Malformed rows go along without their line: a filter would be moved below the
    # watermark, which they have to move.
    line = F.when(F.col("error").isNull(), F.col("raw").cast("binary"))
    rows = parse_feed(timed).select(
        F.coalesce(F.col("partition").cast("string"), F.lit("")).alias("log"),
        "partition", "offset", line.alias("raw"),
        F.unix_micros("timestamp").alias("micros"), "timestamp",
    )
    return rows.groupBy("log").transformWithStateInPandas(
        statefulProcessor=_Chain(idle_seconds, lateness_seconds),
        outputStructType=_OUT, outputMode="Append", timeMode="EventTime",
    )


def keyed_state(spark: SparkSession) -> None:
    """State by key needs a store that can find single keys; set before a query starts."""
    spark.conf.set(_STORE, _KEYED_STORE)


def drain_idle_cut(
    feed: DataFrame, path: str, checkpoint: str, idle_seconds: int, lateness_seconds: int = 0
) -> None:
    """Store the records of all that a stream holds up to each partition's cut, then stop.

    ``path/rows`` gets the records, ``path/closed`` a row per closed partition. A batch that
    runs again replaces its rows.
    """
    spark = feed.sparkSession
    before = spark.conf.get(_STORE)
    keyed_state(spark)

    def store(batch: DataFrame, number: int) -> None:
        kept = batch.filter("not closed").select(
            F.col("raw").cast("string").alias("value"), "partition", "offset",
            F.timestamp_micros("micros").alias("timestamp"),
        )
        valid_records(kept).write.mode("overwrite").parquet(f"{path}/rows/batch_id={number}")
        closed = batch.filter("closed").select(F.timestamp_micros("micros").alias("last_at"))
        closed.write.mode("overwrite").parquet(f"{path}/closed/batch_id={number}")

    try:
        drain(idle_cut_stream(feed, idle_seconds, lateness_seconds), store, checkpoint)
    finally:
        spark.conf.set(_STORE, before)
