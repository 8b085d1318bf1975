"""A stored stream is drained in few micro-batches, whatever its rows; the parser is planned once."""

import datetime as dt

import pytest
from helpers import feed_of
from pyspark.sql import functions as F

from feedloom import scratch
from feedloom.operators.intake import parse_feed
from feedloom.operators.sizing import rows_per_file
from feedloom.plans import queries
from feedloom.sinks.files import write_feed
from feedloom.sources.files import scan_feed, stream_feed
from feedloom.streaming import drain


def tables_of(spark, path, orders):
    """Orders, some without a customer; two nations of two regions."""
    day = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 40 == 9 else i % 7, day + dt.timedelta(days=i % 30), "1-URGENT") for i in range(orders)]
    people = [(i, f"Customer#{i % 5}", i % 2) for i in range(7)]
    for name, schema, values in (
        ("orders", "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING", rows),
        ("customer", "c_custkey BIGINT, c_name STRING, c_nationkey INT", people),
        ("nation", "n_nationkey INT, n_regionkey INT", [(0, 0), (1, 1)]),
        ("region", "r_regionkey INT, r_name STRING", [(0, "ASIA"), (1, "EUROPE")]),
    ):
        spark.createDataFrame(values, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def rows_of(frame):
    return sorted(map(tuple, frame.select("key", "pos", "raw").collect()))


def test_micro_batches_do_not_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """2,000 rows in files of 10 would be 200 files, so 100 micro-batches."""
    sf_dir = tables_of(spark, tmp_path / "tables", 2000)
    monkeypatch.setattr(queries, "STREAM_FILE_ROWS", 10)
    monkeypatch.setattr(queries, "STREAM_FILES", 8, raising=False)
    streamed = rows_of(queries.QUERIES["stream_three_orderings"](spark, sf_dir))
    path = next(p for p in reversed(scratch._given) if "/stream-orderings-" in p)
    batches = [r["batch_id"] for r in spark.read.parquet(f"{path}/parsed").select("batch_id").distinct().collect()]
    # Each task that writes the feed may leave one file that is not full.
    assert 3 <= len(batches) <= (8 + int(spark.conf.get("spark.sql.shuffle.partitions"))) // 2 + 1
    assert streamed == rows_of(queries.QUERIES["three_orderings"](spark, sf_dir))
    assert len(streamed) > 3 * 1500


def test_small_streams_keep_their_files(spark, tmp_path, monkeypatch):
    sf_dir = tables_of(spark, tmp_path / "tables", 200)
    monkeypatch.setattr(queries, "STREAM_FILE_ROWS", 10)
    queries.QUERIES["stream_three_orderings"](spark, sf_dir)
    path = next(p for p in reversed(scratch._given) if "/stream-orderings-" in p)
    held = spark.read.parquet(f"{path}/feed").groupBy(F.col("_metadata.file_path")).count().collect()
    assert max(row["count"] for row in held) == 10


def test_rows_per_file():
    assert [rows_per_file(n, 3000, 100) for n in (0, 1, 300_000, 300_001, 54_000_000)] == [3000, 3000, 3000, 3001, 540_000]
    for wrong in ((10, 0, 1), (10, 1, 0)):
        with pytest.raises(ValueError):
            rows_per_file(*wrong)


def test_parser_is_planned_once_for_all_micro_batches(spark, tmp_path, monkeypatch):
    lines = [None, "", "1,a,b", "x,a,b,c", "+2,a,b,c,d"] + [f"{i},n{i % 3},a,c" for i in range(55)]
    write_feed(feed_of(spark, lines, 4).repartition(6), f"{tmp_path}/feed")
    planned = []

    def counted(feed):
        planned.append(feed.isStreaming)
        return parse_feed(feed)

    monkeypatch.setattr(drain, "parse_feed", counted)
    drain.drain_feed(stream_feed(spark, f"{tmp_path}/feed", 1), f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert planned == [True]
    assert len(list((tmp_path / "out").glob("batch_id=*"))) == 7
    drained, parsed = drain.read_batches(spark, f"{tmp_path}/out"), parse_feed(scan_feed(spark, f"{tmp_path}/feed"))
    assert drained.dtypes == parsed.dtypes
    assert sorted(map(str, drained.collect())) == sorted(map(str, parsed.collect()))
