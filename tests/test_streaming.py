"""Streams give what a batch gives, also across restarts and replays."""

import datetime as dt
import time

import pytest
from helpers import START, feed_of
from pyspark.sql import functions as F

from feedloom.contract import FEED_SCHEMA
from feedloom.operators import ordering
from feedloom.operators.intake import parse_feed, valid_records
from feedloom.sinks.files import write_feed
from feedloom.sources.files import scan_feed, stream_feed
from feedloom.streaming import drain, progress, rates
from test_ordering import messy_feed, positions


def store(spark, path, feed, files=6):
    write_feed(feed.repartition(files), path)
    return scan_feed(spark, path)


def rows_of(frame):
    return sorted(map(tuple, frame.select("partition", "offset", "raw", F.coalesce("error", F.lit(""))).collect()))


def test_drain_takes_all_batches_then_stops(spark, tmp_path):
    feed = store(spark, f"{tmp_path}/feed", messy_feed(spark, 400))
    drain.drain_feed(stream_feed(spark, f"{tmp_path}/feed", 2), f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert len(list((tmp_path / "out").glob("batch_id=*"))) >= 3
    assert rows_of(drain.read_batches(spark, f"{tmp_path}/out")) == rows_of(parse_feed(feed))
    assert not spark.streams.active


def test_restart_takes_only_what_is_new(spark, tmp_path):
    both = messy_feed(spark, 400)
    first, second = both.filter("offset < 50"), both.filter("offset >= 50")
    for part in (first, second):
        part.repartition(2).write.mode("append").parquet(f"{tmp_path}/feed")
        drain.drain_feed(stream_feed(spark, f"{tmp_path}/feed"), f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert rows_of(drain.read_batches(spark, f"{tmp_path}/out")) == rows_of(parse_feed(both))


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    """A batch whose commit is lost runs again on restart."""
    feed = store(spark, f"{tmp_path}/feed", messy_feed(spark, 200))
    drain.drain_feed(stream_feed(spark, f"{tmp_path}/feed", 2), f"{tmp_path}/out", f"{tmp_path}/offsets")
    commits = sorted((tmp_path / "offsets" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    lost = commits[-1]
    for path in (lost, lost.with_name(f".{lost.name}.crc")):
        path.unlink(missing_ok=True)
    drain.drain_feed(stream_feed(spark, f"{tmp_path}/feed", 2), f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert lost.exists()
    assert rows_of(drain.read_batches(spark, f"{tmp_path}/out")) == rows_of(parse_feed(feed))


@pytest.mark.parametrize("files_per_batch", [1, 4, 100])
def test_stream_sort_equals_batch_sort(spark, tmp_path, files_per_batch):
    feed = store(spark, f"{tmp_path}/feed", messy_feed(spark, 600))
    paths = drain.stream_sort(stream_feed(spark, f"{tmp_path}/feed", files_per_batch), str(tmp_path))
    for key, path in paths.items():
        streamed = ordering.read_ordering(spark, path)
        assert positions(streamed) == positions(ordering.sorted_by(valid_records(feed), key))


def test_failure_in_a_batch_fails_the_drain(spark, tmp_path):
    store(spark, f"{tmp_path}/feed", messy_feed(spark, 20), 1)
    with pytest.raises(ValueError, match="unknown sort key"):
        drain.drain_runs(stream_feed(spark, f"{tmp_path}/feed"), f"{tmp_path}/o", f"{tmp_path}/c", ("x",))
    (tmp_path / "blocked").write_text("a file where a folder should go")
    with pytest.raises(Exception):
        drain.drain_feed(stream_feed(spark, f"{tmp_path}/feed"), f"{tmp_path}/blocked", f"{tmp_path}/c2")


@pytest.mark.parametrize("local", ["true", "false"])
def test_sessions_end_at_silences(spark, tmp_path, local):
    """Closed spells come out; a late row moves the watermark past them."""
    lines = [f"{i},n,a,c" for i in range(3)]
    early, late = feed_of(spark, lines, seconds=5), feed_of(spark, ["9,n,a,c"]).withColumn(
        "timestamp", F.col("timestamp") + F.expr("interval 1 hour"))
    for number, part in enumerate((early, late)):
        write_feed(part.withColumn("offset", F.col("offset") + number * 100), f"{tmp_path}/feed/part={number}")
    stream = spark.readStream.schema(FEED_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/feed")
    setting = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    spark.conf.set(setting, local)
    query = (
        drain.intake_sessions(stream, 60).writeStream.format("memory").queryName("spells")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    spark.conf.unset(setting)
    rows = spark.table("spells").collect()
    assert [(r["partition"], r["records"]) for r in rows] == [(0, 3)]
    assert (rows[0]["last_at"] - rows[0]["first_at"]).total_seconds() == 10


def test_running_query_stops_once_idle(spark, tmp_path):
    store(spark, f"{tmp_path}/feed", messy_feed(spark, 50), 2)
    feed = scan_feed(spark, f"{tmp_path}/feed")
    with progress.Intake(spark, every=10) as intake:
        query = (
            progress.observed(parse_feed(stream_feed(spark, f"{tmp_path}/feed", 1)))
            .writeStream.format("memory").queryName("taken").start()
        )
        begin = time.monotonic()
        progress.stop_when_idle(query, intake, idle_seconds=3, poll_seconds=0.2)
        taken = intake.of(query.runId)
    assert not query.isActive and time.monotonic() - begin < 60
    assert spark.table("taken").count() == feed.count() == taken.messages
    assert taken.valid == valid_records(feed).count()
    assert [m[0] for m in taken.milestones][-1] == taken.valid // 10 * 10
    assert [m[0] for m in taken.milestones] == sorted({m[0] for m in taken.milestones})


def test_malformed_rows_do_not_keep_a_query_running(spark, tmp_path):
    """Malformed rows come for ever, several a second; the only valid one came first."""
    rows = spark.readStream.format("rate").option("rowsPerSecond", 20).load()
    line = F.when(F.col("value") == 0, "1,n,a,c").otherwise(F.concat(F.lit("x"), F.col("value").cast("string")))
    feed = rows.select(line.alias("value"), F.lit(0).alias("partition"), F.col("value").alias("offset"), "timestamp")
    with progress.Intake(spark) as intake:
        query = progress.observed(parse_feed(feed)).writeStream.format("noop").option(
            "checkpointLocation", f"{tmp_path}/offsets"
        ).start()
        progress.stop_when_idle(query, intake, idle_seconds=4, poll_seconds=0.1)
        taken = intake.of(query.runId)
    assert not query.isActive
    assert taken.valid == 1 and taken.messages > 20 and taken.batches > 2


class _Query:
    """A query as ``stop_when_idle`` sees it; ``status`` makes its micro-batches."""

    def __init__(self, intake, batches, clock):
        self.runId, self.isActive, self.intake, self.batches, self.clock = "r", True, intake, batches, clock

    @property
    def status(self):
        return {"isTriggerActive": True}

    def look(self, _):
        self.clock[0] += 100
        for valid in self.batches.pop(0) if self.batches else [0]:
            self.intake.of("r").add(5, valid, self.clock[0] - 1, 10)

    def stop(self):
        self.isActive = False

    def exception(self):
        return None


def test_long_polls_miss_no_batch(spark, monkeypatch):
    """Looks 100 s apart and a timeout of 60 s: batches between the looks count."""
    clock = [0.0]
    intake = progress.Intake(spark, 10, lambda: clock[0])
    query = _Query(intake, [[3, 0, 0], [0, 4, 0], [9] * 150, [0, 0]], clock)
    monkeypatch.setattr(progress.time, "sleep", query.look)
    progress.stop_when_idle(query, intake, 60, 100)
    taken = intake.of("r")
    assert taken.valid == 3 + 4 + 9 * 150 and not query.isActive
    assert taken.milestones[-1][0] == taken.valid // 10 * 10


def test_throughput_of_a_stream_tells_late_records(spark, tmp_path):
    """Minutes; a batch per file. Lateness is judged by what had come two batches before."""
    def put(*seconds):
        rows = [("1,n,a,c", 0, i, None if s is None else START + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)]
        rows.append(("malformed", 0, 99, START + dt.timedelta(days=9)))  # moves no watermark
        spark.createDataFrame(rows, "value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP").coalesce(
            1).write.mode("append").parquet(f"{tmp_path}/feed")

    limits = (60, "2024-01-01 00:00:10", 30)

    def run():
        rates.drain_throughput(stream_feed(spark, f"{tmp_path}/feed", 1), f"{tmp_path}/out", f"{tmp_path}/o", *limits)
        found = rates.read_throughput(spark, f"{tmp_path}/out", *limits).collect()
        return sorted((tuple(r) for r in found), key=lambda r: (r[0] is None, r[0]))

    put(5, 10, 69, None)  # interval -1, 0, 0
    put(71, 200)  # 1, 3
    put(75, 205)
    assert run() == [(-1, 1, 0, True), (0, 2, 0, True), (1, 2, 0, True), (3, 2, 0, False), (None, 1, 0, None)]
    put(20, 80, 140)  # 0 and 1 are over, 2 is open
    assert run() == [
        (-1, 1, 0, True), (0, 2, 1, True), (1, 2, 1, True), (2, 1, 0, False), (3, 2, 0, False), (None, 1, 0, None),
    ]
    put(500)
    put(15, 501)
    found = run()
    assert found[1:5] == [(0, 2, 2, True), (1, 2, 1, True), (2, 1, 0, True), (3, 2, 0, True)]
    assert sum(r[1] + r[2] for r in found) == 14


def test_throughput_of_a_stream_without_rows(spark, tmp_path):
    spark.createDataFrame([], FEED_SCHEMA).write.parquet(f"{tmp_path}/feed")
    limits = (60, "2024-01-01 00:00:00")
    rates.drain_throughput(stream_feed(spark, f"{tmp_path}/feed"), f"{tmp_path}/out", f"{tmp_path}/o", *limits)
    assert rates.read_throughput(spark, f"{tmp_path}/out", *limits).collect() == []
    with pytest.raises(ValueError, match="positive"):
        rates.drain_throughput(stream_feed(spark, f"{tmp_path}/feed"), f"{tmp_path}/a", f"{tmp_path}/b", 0, limits[1])
