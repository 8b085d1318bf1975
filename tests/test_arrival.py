"""Operators on arrival order, with chunks small enough to matter."""

import pytest
from helpers import START, feed_of
from pyspark.sql import functions as F

from feedloom.contract import FEED_SCHEMA
from feedloom.operators import arrival, quota
from feedloom.operators.intake import valid_records
from feedloom.operators.runs import sorted_runs
from feedloom.sinks.files import write_feed
from feedloom.sources.files import scan_feed

CHUNKS = (1, 3, 10, 1_000_000)


def gappy(spark, n=200):
    """Two partitions, one three times the other, with holes where rows are malformed."""
    lines = [f"{i},n,a,c" if i % 7 else "broken" for i in range(n)]
    feed = feed_of(spark, lines, 4)
    return valid_records(feed.withColumn(
        "offset", F.col("offset") * 4 + F.when(F.col("partition") == 3, 0).otherwise(F.col("partition"))
    ).withColumn("partition", F.when(F.col("partition") == 3, 1).otherwise(0)))


def arrived(records):
    rows = {}
    for row in sorted(records.collect(), key=lambda r: (r["partition"], r["offset"])):
        rows.setdefault(row["partition"], []).append(row)
    return rows


@pytest.mark.parametrize("chunk", CHUNKS)
def test_rank(spark, chunk):
    records = gappy(spark)
    found = {(r["partition"], r["offset"]): r["rank"]
             for r in arrival.with_arrival_rank(records, chunk).collect()}
    assert found == {
        (p, row["offset"]): i + 1 for p, rows in arrived(records).items() for i, row in enumerate(rows)
    }


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("n", [1, 2, 43, 44, 100, 10_000])
def test_cap(spark, chunk, n):
    records = gappy(spark)
    found = sorted((r["partition"], r["offset"]) for r in arrival.cap_per_partition(records, n, chunk).collect())
    assert found == [(p, r["offset"]) for p, rows in sorted(arrived(records).items()) for r in rows[:n]]


def test_no_cap(spark):
    records = gappy(spark)
    assert arrival.cap_per_partition(records, 0).count() == records.count()
    with pytest.raises(ValueError):
        arrival.cap_per_partition(records, -1)


def test_expected_count(spark):
    records = gappy(spark)
    sizes = {p: len(rows) for p, rows in arrived(records).items()}
    small, large = sorted(sizes.values())
    kept = arrival.expected_count(records, large, 10).groupBy("partition").agg(
        F.count("*").alias("n"), F.bool_and("complete").alias("all"), F.bool_or("complete").alias("any"))
    found = {r["partition"]: (r["n"], r["all"], r["any"]) for r in kept.collect()}
    assert found == {p: (n, n == large, n == large) for p, n in sizes.items()}
    assert small < large


@pytest.mark.parametrize("chunk", CHUNKS)
def test_batches(spark, chunk):
    records = gappy(spark)
    found = {(r["partition"], r["offset"]): (r["batch"], r["slot"])
             for r in arrival.fixed_batches(records, 8, chunk).collect()}
    assert found == {
        (p, row["offset"]): divmod(i, 8) for p, rows in arrived(records).items() for i, row in enumerate(rows)
    }


def test_five_rows_in_batches_of_two(spark):
    records = valid_records(feed_of(spark, [f"{i},a,b,c" for i in range(5)]))
    sizes = arrival.fixed_batches(records, 2).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in sizes] == [2, 2, 1]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_milestones(spark, chunk):
    records = gappy(spark)
    found = {(r["partition"], r["records"]): (r["reached_at"], r["rate"])
             for r in arrival.milestones(records, 20, chunk).collect()}
    expected = {}
    for p, rows in arrived(records).items():
        first = min(r["timestamp"] for r in rows)
        for rank in range(20, len(rows) + 1, 20):
            at = rows[rank - 1]["timestamp"]
            expected[p, rank] = (at, rank / (at - first).total_seconds())
    assert found == expected


def test_milestone_without_time_has_no_rate(spark):
    records = valid_records(feed_of(spark, ["1,a,b,c"] * 4, seconds=0))
    assert [r["rate"] for r in arrival.milestones(records, 2).collect()] == [None, None]


def test_large_summaries_are_not_broadcast(spark):
    records = gappy(spark)
    expected = sorted(arrival.cap_per_partition(records, 5, 3).collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sorted(arrival.cap_per_partition(records, 5, 3).collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("partition, offset", [(None, 1), (0, None), (None, None)])
def test_rows_without_a_place_stay(spark, partition, offset):
    places = [(0, 0), (0, 5), (partition, offset)]
    rows = [(f"{i},n,a,c", *place, START) for i, place in enumerate(places)]
    feed = spark.createDataFrame(rows, FEED_SCHEMA)
    records = valid_records(feed)
    assert arrival.with_arrival_rank(records).count() == arrival.fixed_batches(feed).count() == 3
    assert arrival.cap_per_partition(records, 9).count() == arrival.expected_count(records, 9).count() == 3
    assert sorted_runs(records, 2).count() == 9
    sizes = {r["partition"]: r["count"] for r in records.groupBy("partition").count().collect()}
    assert arrival.milestones(records, 1).count() == 3
    capped = arrival.cap_per_partition(records, 1).collect()
    assert len(capped) == len(sizes)


def test_cap_and_count_scan_the_feed_twice_at_most(spark, tmp_path):
    """Once for the histogram, which is stored, and once for the rows."""
    write_feed(feed_of(spark, [f"{i},n,a,c" for i in range(50)], 4), str(tmp_path))
    records = valid_records(scan_feed(spark, str(tmp_path)))
    for frame in (arrival.cap_per_partition(records, 5), arrival.expected_count(records, 5)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"{tmp_path.name}]") == 1


@pytest.mark.parametrize("total, workers, sizes", [
    (840, 12, [70] * 12),
    (17, 4, [5, 4, 4, 4]),
    (1_000_003, 2, [500_002, 500_001]),
    (2, 3, [2, 0, 0]),
    (0, 3, [0, 0, 0]),
])
def test_quota(spark, total, workers, sizes):
    assert quota.quota_sizes(total, workers) == sizes
    numbered = spark.range(1, total + 1).withColumnRenamed("id", "pos")
    rows = quota.with_shard(numbered, total, workers).collect()
    assert [sum(r["shard"] == w for r in rows) for w in range(workers)] == sizes
    assert [r["shard"] for r in sorted(rows)] == sorted(r["shard"] for r in rows)


def test_bad_parameters(spark):
    records = gappy(spark, 4)
    for call in (
        lambda: arrival.fixed_batches(records, 0), lambda: arrival.milestones(records, 0),
        lambda: arrival.expected_count(records, 0), lambda: arrival.with_arrival_rank(records, 0),
        lambda: quota.quota_sizes(3, 0),
    ):
        with pytest.raises(ValueError):
            call()
