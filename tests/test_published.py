"""Orderings that leave as text or messages, and feeds that come as text or streams."""

import pytest
from helpers import feed_of
from pyspark.sql import functions as F

from feedloom.contract import SORT_KEYS
from feedloom.operators import ordering
from feedloom.operators.intake import valid_records
from feedloom.operators.runs import sorted_runs
from feedloom.operators.verify import sortedness
from feedloom.plans import job
from feedloom.sinks.files import write_feed, write_stored_lines
from feedloom.sinks.kafka import stored_messages
from feedloom.sources.files import lines_feed, read_ordered_lines, stream_feed
from test_ordering import messy_feed


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def stored(spark, tmp_path):
    records = valid_records(messy_feed(spark, 300))
    ordering.store_ordering(records, "name", f"{tmp_path}/stored", 5)
    return f"{tmp_path}/stored"


@pytest.mark.parametrize("files", [1, 3, 1000])
def test_text_of_an_ordering_comes_back_in_order(spark, tmp_path, stored, files):
    # Text has one line for each record, so only records of one line can come back.
    records = spark.createDataFrame([(f"{i % 7},n{i % 5},a,c", i % 7, f"n{i % 5}", "c", 0, i) for i in range(200)],
                                    "raw string, id long, name string, continent string, partition int, offset long")
    path = f"{tmp_path}/lines-stored"
    ordering.store_ordering(records, "name", path, 4)
    write_stored_lines(spark, path, f"{tmp_path}/text", files)
    back = read_ordered_lines(spark, f"{tmp_path}/text", f"{tmp_path}/read")
    wanted = ordering.read_ordering(spark, path).select("pos", "raw")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wanted.collect()))


def test_messages_are_dealt_by_position_without_another_sort_by_key(spark, stored):
    frame = stored_messages(spark, stored, 4)
    assert "rangepartitioning" not in plan_of(frame)
    rows = frame.collect()
    wanted = [r["raw"] for r in ordering.read_ordering(spark, stored).orderBy("pos").collect()]
    assert [r["value"] for r in sorted(rows, key=lambda r: r["partition"])] == wanted
    sizes = [sum(r["partition"] == p for r in rows) for p in range(4)]
    assert max(sizes) - min(sizes) <= 1


def test_unfinished_ordering_is_not_published(spark, tmp_path, stored):
    spark.createDataFrame([], ordering.TOTAL).write.mode("overwrite").parquet(f"{stored}/total")
    with pytest.raises(RuntimeError, match="not finished"):
        stored_messages(spark, stored, 4)


def test_lines_doubled_or_lost_on_the_way_are_seen(spark, stored):
    records = ordering.read_ordering(spark, stored)
    lines = records.select("raw")
    job.check_published(records, {"name": lines})
    for came in (lines.limit(5), lines.unionByName(lines.limit(1))):
        with pytest.raises(RuntimeError, match="differ"):
            job.check_published(records, {"name": came})


def test_text_as_a_feed(spark, tmp_path):
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "a.txt").write_bytes(b"3,c,x,Asia\r\n1,a,x,Africa\nbroken\n")
    (tmp_path / "text" / "b.txt").write_bytes(b"2,b,x,Europe")
    feed = lines_feed(spark, f"{tmp_path}/text", f"{tmp_path}/feed")
    assert feed.select("partition", "offset").distinct().count() == 4
    paths = job.order_feed(feed, f"{tmp_path}/out")
    lines = [r["raw"] for r in ordering.read_ordering(spark, paths["id"]).orderBy("pos").collect()]
    assert lines == ["1,a,x,Africa", "2,b,x,Europe", "3,c,x,Asia"]
    job.check(job.report(spark, f"{tmp_path}/out"))


def test_stream_to_all_orderings_with_a_restart(spark, tmp_path):
    feed = messy_feed(spark, 400)
    for part in (feed.filter("offset < 50"), feed.filter("offset >= 50")):
        part.repartition(3).write.mode("append").parquet(f"{tmp_path}/feed")
        paths = job.order_stream(stream_feed(spark, f"{tmp_path}/feed", 1), f"{tmp_path}/out")
    for key in SORT_KEYS:
        rows = ordering.read_ordering(spark, paths[key]).orderBy("pos").collect()
        wanted = ordering.sorted_by(valid_records(feed), key).orderBy("pos").collect()
        assert [tuple(r)[:-1] for r in rows] == [tuple(r) for r in wanted]
    reports = job.report(spark, f"{tmp_path}/out")
    job.check(reports)
    assert reports["intake"].agg(F.sum("messages")).first()[0] == feed.count()


def test_empty_stream_gives_empty_orderings(spark, tmp_path):
    write_feed(feed_of(spark, ["1,a,b,c"]).limit(0), f"{tmp_path}/feed")
    paths = job.order_stream(stream_feed(spark, f"{tmp_path}/feed"), f"{tmp_path}/out")
    assert [ordering.read_ordering(spark, p).count() for p in paths.values()] == [0, 0, 0]


def test_runs_carry_sort_columns_only_and_are_multiplied_last(spark):
    runs = sorted_runs(valid_records(messy_feed(spark, 300)), 50)
    assert not {"address", "timestamp"} & set(runs.columns)
    plan = plan_of(runs)
    assert "Exchange" not in plan[:plan.index("Generate")] and "AS address" not in plan


@pytest.mark.parametrize("positions, numbered", [
    ([1, 2, 3, 4], True), ([1, 1, 3, 4], False), ([1, 2, 4, 5], False), ([2, 3, 4], False),
    ([0, 1, 2], False), ([1, 2, 2, 3], False), ([], True), ([1], True),
])
@pytest.mark.parametrize("chunk", [1, 2, 1000])
def test_doubled_and_missing_positions(spark, positions, numbered, chunk):
    rows = spark.createDataFrame([(p, 5) for p in positions], "pos long, id long")
    by = F.floor(F.col("pos") / chunk)
    assert sortedness(rows, "id", chunk=by, numbers=True).first()["is_numbered"] is numbered
