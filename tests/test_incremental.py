"""Orderings that grow by batches, and merges that use the marks of their runs."""

from pathlib import Path

import pytest
from helpers import feed_of
from pyspark.sql import functions as F

from feedloom.contract import SORT_KEYS, sort_columns
from feedloom.operators import ordering, ranges
from feedloom.operators.intake import valid_records
from feedloom.operators.runs import merge_stored, sorted_runs, splitters
from feedloom.operators.verify import sortedness
from feedloom.plans import job
from feedloom.sinks.files import write_runs
from feedloom.sources.files import stream_feed
from test_ordering import expected_order, messy_feed, positions


@pytest.mark.parametrize("key", SORT_KEYS)
def test_batches_give_the_ordering_of_all(spark, tmp_path, key):
    records = valid_records(messy_feed(spark, 900))
    path = str(tmp_path)
    for part in ("id % 3 = 0", "id % 3 = 1 and id > 400", "id % 3 = 2", "id % 3 = 1 and id <= 400", "id < -1000"):
        ordering.extend_ordering(records.filter(part), key, path)
    kept = records.filter("id % 3 in (0, 1, 2)")
    stored = ordering.read_ordering(spark, path)
    assert positions(stored) == expected_order(kept, key)
    checked = sortedness(stored, key, chunk=F.col("bucket"), numbers=True).first()
    assert checked["is_sorted"] and checked["is_numbered"] and checked["rows"] == kept.count()
    assert positions(ordering.read_head(spark, path, 20)) == expected_order(kept, key)[:20]
    assert ordering.sweep(spark, path) > 0 and ordering.sweep(spark, path) == 0
    assert positions(ordering.read_ordering(spark, path)) == expected_order(kept, key)


def names_of(path):
    return {str(f.relative_to(path)) for f in Path(path).glob("rows/gen=*/*.parquet")}


def test_untouched_ranges_keep_their_files(spark, tmp_path):
    path = str(tmp_path)
    records = valid_records(feed_of(spark, [f"{i},n,a,c" for i in range(0, 4000, 2)], 4))
    ordering.store_ordering(records, "id", path, 20)
    before = names_of(path)
    new = valid_records(feed_of(spark, [f"{i},n,a,c" for i in range(1001, 1101, 2)], 4)).withColumn(
        "offset", F.col("offset") + 100_000)
    ordering.extend_ordering(new, "id", path)
    ordering.sweep(spark, path)
    after = names_of(path)
    assert len(before & after) >= 18 and len(before - after) <= 2
    ids = [r["id"] for r in ordering.read_ordering(spark, path).orderBy("pos").collect()]
    assert ids == sorted([*range(0, 4000, 2), *range(1001, 1101, 2)])


def test_a_batch_is_added_once(spark, tmp_path):
    records, path = valid_records(messy_feed(spark, 100)), str(tmp_path)
    for number in (0, 0, 1, 1, 0):
        ordering.extend_ordering(records.filter(f"offset % 2 = {number}"), "name", path, number)
    assert positions(ordering.read_ordering(spark, path)) == expected_order(records, "name")


def test_a_batch_that_fails_leaves_the_ordering_as_it_was(spark, tmp_path, monkeypatch):
    records, path = valid_records(messy_feed(spark, 200)), str(tmp_path)
    ordering.extend_ordering(records.filter("offset < 20"), "name", path, 0)
    before = positions(ordering.read_ordering(spark, path))

    def broken(*_):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(ordering, "_write_pieces", broken)
    with pytest.raises(RuntimeError, match="lost"):
        ordering.extend_ordering(records.filter("offset >= 20"), "name", path, 1)
    monkeypatch.undo()
    assert positions(ordering.read_ordering(spark, path)) == before
    ordering.extend_ordering(records.filter("offset >= 20"), "name", path, 1)
    assert positions(ordering.read_ordering(spark, path)) == expected_order(records, "name")


def test_stream_adds_batch_by_batch(spark, tmp_path):
    feed = messy_feed(spark, 300)
    for part in ("offset < 20", "offset >= 20 and offset < 50", "offset >= 50"):
        feed.filter(part).repartition(2).write.mode("append").parquet(f"{tmp_path}/feed")
        paths = job.order_stream_by_batches(stream_feed(spark, f"{tmp_path}/feed", 1), f"{tmp_path}/out")
    for key in SORT_KEYS:
        assert positions(ordering.read_ordering(spark, paths[key])) == expected_order(valid_records(feed), key)
    job.check(job.report(spark, f"{tmp_path}/out"))


def test_search_among_bounds(spark):
    records = valid_records(messy_feed(spark, 200))
    for key in SORT_KEYS:
        rows = records.orderBy(*sort_columns(key)).select(ranges.key_of(key).alias("k")).collect()
        for step in (1, 3, 50, 1000):
            bounds = [r["k"] for r in rows[::step]]
            found = records.orderBy(*sort_columns(key)).select(ranges.range_of(key, bounds).alias("r")).collect()
            assert [r["r"] for r in found] == [i // step + 1 for i in range(len(rows))]
    assert records.select(ranges.range_of("id", []).alias("r")).distinct().collect()[0]["r"] == 0


@pytest.mark.parametrize("every, n", [(10, 6), (7, 3), (100, 8)])
def test_ranges_of_a_merge_are_bounded_with_a_hot_key(spark, tmp_path, every, n):
    lines = [f"{i % 900},{'same' if i % 3 else f'n{i % 40}'},a,Asia" for i in range(2800)]
    records = valid_records(feed_of(spark, lines, 4))
    write_runs(sorted_runs(records, 100), f"{tmp_path}/runs", every)
    stored = spark.read.parquet(f"{tmp_path}/runs")
    for key in SORT_KEYS:
        runs = stored.filter(F.col("key") == key)
        n_runs, marks = runs.select("partition", "run").distinct().count(), runs.filter("mark = 1").count()
        assert marks == sum(100 // every for _ in range(n_runs))
        bounds = splitters(runs.filter("mark = 1"), key, n)
        merge_stored(runs, key, f"{tmp_path}/{key}", n)
        merged = ordering.read_ordering(spark, f"{tmp_path}/{key}")
        assert positions(merged) == expected_order(records, key)
        sizes = [r["count"] for r in merged.groupBy("bucket").count().collect()]
        assert len(bounds) <= n and max(sizes) <= -(-marks // n) * every + n_runs * (every - 1)
        plan = ranges.deal(runs, key, bounds)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
