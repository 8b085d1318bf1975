"""Publishing that goes on, named differences, gaps of offsets, replays and live idle cuts."""

import datetime as dt
from collections import Counter

import pytest
from helpers import START, feed_of
from pyspark.sql import functions as F

from feedloom.contract import FEED_SCHEMA
from feedloom.operators import accounting, ordering
from feedloom.operators.differences import differing_prefixes, reconcile_diff
from feedloom.operators.intake import parse_feed, valid_records
from feedloom.operators.offsets import BLOCK, offset_gaps
from feedloom.sinks import resumed
from feedloom.sources.files import stream_feed
from feedloom.streaming import drain, idle, replay
from test_ordering import messy_feed


@pytest.fixture()
def stored(spark, tmp_path):
    lines = [f"{i},n{i % 5},a,c" for i in range(237)]
    ordering.store_ordering(valid_records(feed_of(spark, lines, 4)), "name", f"{tmp_path}/stored", 5)
    return f"{tmp_path}/stored"


def test_publishing_goes_on_where_it_was_stopped(spark, tmp_path, stored):
    target, taken = f"{tmp_path}/text", []

    def write(rows, stretch):
        if stretch == 2 and 2 not in taken:
            taken.append(stretch)
            rows.limit(3).select("raw").write.text(f"{target}/stretch={stretch:06d}")
            raise RuntimeError("lost the driver")
        taken.append(stretch)
        rows.select("raw").write.mode("overwrite").text(f"{target}/stretch={stretch:06d}")

    with pytest.raises(RuntimeError, match="lost"):
        resumed.publish_resumed(spark, stored, target, 5, 3, write)
    with pytest.raises(RuntimeError, match="not all"):
        resumed.read_published(spark, target)
    assert resumed.publish_resumed(spark, stored, target, 5, 3, write) == [2, 3, 4]
    assert taken == [0, 1, 2, 2, 3, 4] and resumed.publish_resumed(spark, stored, target, 5, 3) == []
    wanted = ordering.read_ordering(spark, stored).select("pos", "raw").collect()
    assert sorted(map(tuple, resumed.read_published(spark, target).collect())) == sorted(map(tuple, wanted))
    with pytest.raises(RuntimeError, match="another"):
        resumed.publish_resumed(spark, stored, target, 4, 3)
    ordering.extend_ordering(valid_records(feed_of(spark, ["9,n,a,c"])), "name", stored)
    with pytest.raises(RuntimeError, match="another"):
        resumed.publish_resumed(spark, stored, target, 5, 3)


@pytest.mark.parametrize("stretches", [1, 300])
def test_stretches_of_any_number(spark, tmp_path, stored, stretches):
    few = f"{tmp_path}/few"
    ordering.store_ordering(valid_records(feed_of(spark, ["2,b,a,c", "1,c,a,c"])), "id", few)
    resumed.publish_resumed(spark, few, f"{tmp_path}/t", min(stretches, 7), 2)
    assert [r["raw"][0] for r in resumed.read_published(spark, f"{tmp_path}/t").orderBy("pos").collect()] == ["1", "2"]


def test_differences_are_named(spark):
    draw = [f"{i % 60},x" for i in range(400)]
    produced = spark.createDataFrame([(r,) for r in draw], "raw string")
    faulty = Counter(draw)
    faulty["3,x"] -= 2
    faulty["7,x"] += 1
    faulty["new"] = 2
    del faulty["9,x"]
    came = [("a", r) for r in Counter(draw).elements()] + [("b", r) for r in faulty.elements()]
    delivered = spark.createDataFrame(came, "key string, raw string")
    for levels in ((12, 12), (1, 1, 1), (40,)):
        found = set(map(tuple, reconcile_diff(produced, delivered, ("a", "b", "c"), levels).filter("key <> 'c'").collect()))
        n9 = Counter(draw)["9,x"]
        assert found == {("b", "3,x", 2, 0), ("b", "7,x", 0, 1), ("b", "new", 0, 2), ("b", "9,x", n9, 0)}
    lost = reconcile_diff(produced, delivered, ("c",)).agg(F.sum("missing"), F.sum("doubled")).first()
    assert tuple(lost) == (400, 0)
    assert reconcile_diff(produced.limit(0), delivered.limit(0), ("a",)).count() == 0


def test_equal_sides_open_nothing(spark):
    produced = spark.createDataFrame([(f"{i % 60},x",) for i in range(400)], "raw string")
    delivered = produced.withColumn("key", F.explode(F.array(F.lit("a"), F.lit("b")))).orderBy("raw")
    found, made, came, _ = differing_prefixes(produced, delivered, ("a", "b"))
    assert found.count() == made.count() == came.count() == 0


def brute_gaps(places):
    out = set()
    for p in {p for p, _ in places}:
        held = Counter(o for q, o in places if q == p and o is not None)
        if not held:
            continue
        last = None
        for o in range(min(held), max(held) + 1):
            kind = "missing" if o not in held else "repeated" if held[o] > 1 else None
            if kind and last and last[2] == kind and last[1] == o - 1:
                last[1] = o
            else:
                if last:
                    out.add((p, *last))
                last = [o, o, kind] if kind else None
        if last:
            out.add((p, *last))
    return out


@pytest.mark.parametrize("start", [0, BLOCK - 5, -BLOCK - 3])
def test_gaps_and_repeats(spark, start):
    places = [(0, start + o) for o in range(40) if o % 7 not in (3, 4)] + [(0, start + 9), (0, start + 10), (0, start + 12)]
    places += [(1, 5), (1, 5), (1, 5), (None, 1), (None, 4), (2, 7), (0, None)] + [(3, 2), (3, 3 * BLOCK + 1)]
    frame = spark.createDataFrame([(p, o) for p, o in places], "partition int, offset long")
    assert set(map(tuple, offset_gaps(frame).collect())) == brute_gaps(places)
    assert offset_gaps(frame.limit(0)).count() == 0


def test_rows_that_come_again_count_once(spark, tmp_path):
    feed = messy_feed(spark, 200)
    timeless = feed.withColumn("timestamp", F.lit(None).cast("timestamp")).withColumn("offset", F.col("offset") + 1000)
    unplaced = spark.createDataFrame([("1,a,b,c", None, 1, START), ("1,a,b,c", 0, None, START)] * 2, FEED_SCHEMA)
    everything = feed.unionByName(timeless).unionByName(unplaced)
    for part in (everything.filter("offset < 30 or offset is null"), feed, timeless, feed.filter("offset < 40")):
        part.write.mode("append").parquet(f"{tmp_path}/feed")
        replay.drain_distinct(stream_feed(spark, f"{tmp_path}/feed"), f"{tmp_path}/rows", f"{tmp_path}/offsets", "1 second")
    found = replay.read_distinct(spark, f"{tmp_path}/rows")
    columns = ["raw", "partition", "offset", "error"]
    wanted = parse_feed(everything).select(*columns).collect()
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(map(tuple, wanted))


def moments(spark, rows):
    """(partition, second, line) as a feed."""
    return spark.createDataFrame(
        [(line, p, i, START + dt.timedelta(seconds=s) if s is not None else None) for i, (p, s, line) in enumerate(rows)],
        FEED_SCHEMA,
    )


OK, BAD = "1,a,b,c", "broken"


@pytest.mark.parametrize("lateness, batches", [
    (0, [[(0, 0, OK), (0, 5, OK), (1, 3, OK)], [(0, 14, OK), (1, 30, OK)], [(0, 40, OK), (1, 41, OK)], [(0, 41, OK)]]),
    (30, [[(0, 20, OK), (1, 20, OK)], [(0, 12, OK), (0, 5, OK)], [(0, 29, OK), (0, 90, OK)], [(1, 91, OK), (0, 150, OK)]]),
    (0, [[(0, 0, OK), (None, 1, OK)], [(0, None, OK), (None, 30, OK)], [(0, 9, OK), (None, 40, OK)], [(0, 99, OK)]]),
])
def test_live_cut_is_that_of_the_whole_feed(spark, tmp_path, lateness, batches):
    whole = []
    for batch in batches:
        frame = moments(spark, batch).withColumn("offset", F.col("offset") + len(whole))
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
        whole.append(frame)
        for _ in batch[1:]:
            whole.append(frame.limit(0))
    idle.drain_idle_cut(stream_feed(spark, f"{tmp_path}/feed", 1), f"{tmp_path}/out", f"{tmp_path}/offsets", 10, lateness)
    feed = whole[0]
    for frame in whole[1:]:
        feed = feed.unionByName(frame)
    wanted = accounting.idle_cut(valid_records(feed), 10)
    found = drain.read_batches(spark, f"{tmp_path}/out/rows")
    columns = ["partition", "offset", "raw", "timestamp"]
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(map(tuple, wanted.select(*columns).collect()))


def test_malformed_rows_do_not_keep_a_partition_open(spark, tmp_path):
    """They move the clock, not the partition's end; a restart goes on with the state."""
    batches = [[(0, 0, OK), (0, 4, OK)], [(0, 12, BAD), (0, 20, BAD)], [(0, 25, BAD)], [(0, 26, OK)]]
    for number, batch in enumerate(batches):
        moments(spark, batch).withColumn("offset", F.col("offset") + 10 * number).coalesce(1).write.mode(
            "append").parquet(f"{tmp_path}/feed")
        idle.drain_idle_cut(stream_feed(spark, f"{tmp_path}/feed", 1), f"{tmp_path}/out", f"{tmp_path}/offsets", 10)
        if number == 2:
            closed = spark.read.parquet(f"{tmp_path}/out/closed").collect()
            assert [r["last_at"].replace(tzinfo=dt.timezone.utc) for r in closed] == [START + dt.timedelta(seconds=4)]
    assert sorted(r["offset"] for r in drain.read_batches(spark, f"{tmp_path}/out/rows").collect()) == [0, 1]
    assert spark.read.parquet(f"{tmp_path}/out/closed").count() == 1
    with pytest.raises(ValueError):
        idle.idle_cut_stream(stream_feed(spark, f"{tmp_path}/feed"), 0)
