"""Sources, sinks, the generator's laws, and the whole job."""

import pytest
from helpers import feed_of
from pyspark.sql import functions as F

from feedloom import scratch
from feedloom.contract import (
    ADDRESS_CHARACTERS, CONTINENTS, FEED_COLUMNS, LETTERS, SORT_KEYS,
)
from feedloom.operators import ordering
from feedloom.operators.intake import parse_feed, rejects, valid_records
from feedloom.plans import job
from feedloom.sinks import kafka as kafka_sink
from feedloom.sinks.files import write_feed, write_lines
from feedloom.sources import kafka
from feedloom.sources.files import scan_feed, scan_lines
from feedloom.sources.synthetic import generate_feed
from test_ordering import expected_order, messy_feed, positions


def test_generated_records_follow_the_laws(spark):
    n = 20_000
    feed = generate_feed(spark, n, seed=5)
    records = valid_records(feed)
    assert records.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first() == (n, n, 1, n)
    lengths = records.agg(
        F.min(F.length("name")), F.max(F.length("name")),
        F.min(F.length("address")), F.max(F.length("address"))).first()
    assert tuple(lengths) == (10, 15, 15, 20)
    used = {
        column: {r[0] for r in records.select(F.explode(F.split(column, ""))).distinct().collect()}
        for column in ("name", "address")
    }
    assert used == {"name": set(LETTERS), "address": set(ADDRESS_CHARACTERS)}
    shares = {r["continent"]: r["count"] / n for r in records.groupBy("continent").count().collect()}
    assert set(shares) == set(CONTINENTS)
    assert all(abs(share - 1 / 6) < 0.02 for share in shares.values())
    letters = records.select(F.explode(F.split("name", "")).alias("c")).groupBy("c").count().collect()
    mean = sum(r["count"] for r in letters) / len(LETTERS)
    assert all(abs(r["count"] / mean - 1) < 0.1 for r in letters)


def test_generator_depends_on_seed_only(spark):
    lines = {t: sorted(map(tuple, generate_feed(spark, 500, 7, tasks=t).collect())) for t in (1, 7)}
    assert lines[1] == lines[7]
    assert lines[1] != sorted(map(tuple, generate_feed(spark, 500, 8).collect()))
    assert generate_feed(spark, 500).select("partition", "offset").distinct().count() == 500


def test_feed_comes_back_as_written(spark, tmp_path):
    feed = feed_of(spark, ["1,a,b,c", None, "x\ny", b"\xff\xfe"], 2)
    write_feed(feed, str(tmp_path), records_per_file=1)
    back = scan_feed(spark, str(tmp_path))
    as_bytes = [F.col("value").cast("binary").alias("value"), *FEED_COLUMNS[1:]]
    assert back.columns == list(FEED_COLUMNS)
    assert sorted(map(str, back.select(as_bytes).collect())) == sorted(map(str, feed.select(as_bytes).collect()))
    files = spark.read.parquet(str(tmp_path)).groupBy("_metadata.file_path").count().collect()
    assert [r["count"] for r in files] == [1] * 4


def test_lines_split_at_newlines_only(spark, tmp_path):
    long = "9," + "x" * 3_000_000 + ",a,b"
    lines = ["1,a,b,c", "2,a\rb,c,d\r", "", "3,é,x,y\r\r", long]
    write_lines(feed_of(spark, lines), str(tmp_path))
    found = sorted(r["line"] for r in scan_lines(spark, str(tmp_path)).collect())
    assert found == sorted(["1,a,b,c", "2,a\rb,c,d", "", "3,é,x,y\r", long])


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_feed(spark, f"{tmp_path}/none")


def test_kafka_options():
    assert kafka.batch_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t",
        "startingOffsets": "earliest", "endingOffsets": "latest",
    }
    assert kafka.stream_options("h:1", "t", 2000)["maxOffsetsPerTrigger"] == "2000"
    assert "endingOffsets" not in kafka.stream_options("h:1", "t")
    assert kafka_sink.ORDERING_OPTIONS["kafka.acks"] == "all"
    assert kafka_sink.FEED_OPTIONS["kafka.compression.type"] == "snappy"


def test_whole_job(spark, tmp_path):
    feed = messy_feed(spark)
    paths = job.order_feed(feed, str(tmp_path))
    assert set(paths) == set(SORT_KEYS)
    records = valid_records(feed)
    for key in SORT_KEYS:
        assert positions(ordering.read_ordering(spark, paths[key])) == expected_order(records, key)
    reports = job.report(spark, str(tmp_path))
    n = records.count()
    assert all(
        (r["produced"], r["delivered"], r["contents_match"]) == (n, n, True)
        for r in reports["delivery"].collect()
    )
    for key in SORT_KEYS:
        checked = reports[f"sorted_by_{key}"].first()
        assert (checked["rows"], checked["inversions"], checked["first_bad_pos"]) == (n, 0, None)
        assert checked["is_sorted"] and checked["is_numbered"]
    assert reports["intake"].agg(F.sum("valid")).first()[0] == n
    found = job.read_rejects(spark, f"{tmp_path}/parsed").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, rejects(feed).collect()))


def test_running_the_job_again_replaces_its_output(spark, tmp_path):
    feed = messy_feed(spark, 300)
    for _ in range(2):
        paths = job.order_feed(feed, str(tmp_path), ("name",))
    assert ordering.read_ordering(spark, paths["name"]).count() == valid_records(feed).count()


def test_a_failed_sort_fails_the_job(spark, tmp_path):
    feed = messy_feed(spark, 100)
    (tmp_path / "key=name").write_text("a file where a folder should go")
    with pytest.raises(Exception):
        job.order_feed(feed, str(tmp_path))
    with pytest.raises(ValueError, match="unknown sort key"):
        job.store_orderings(valid_records(feed), str(tmp_path), ("id", "x"))


def test_measured_bytes(spark, tmp_path):
    feed = feed_of(spark, ["1,a,b,c", None, "é"])
    assert job.store_parsed(feed, str(tmp_path)) == 7 + 0 + 2
    assert spark.read.parquet(str(tmp_path)).count() == parse_feed(feed).count()


def test_scratch_lies_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.new_path(spark, "x"), scratch.new_path(spark, "x")
    assert first.startswith(folder) and first != second


def test_scratch_without_a_setting(spark):
    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        class conf:
            @staticmethod
            def get(_, default=None):
                return default

        def __init__(self, master):
            self.sparkContext = Context(master)

    local = Session("local[2]")
    assert scratch.shared_folder(local) == scratch.shared_folder(local) == local.sparkContext.folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session("spark://host:1"))


def test_limits_of_the_job(spark, tmp_path):
    lines = [f"{i},n{i % 3},a,c" for i in range(60)]
    feed = feed_of(spark, lines, 2).withColumn(
        "timestamp", F.when(F.col("offset") >= 20, F.col("timestamp") + F.expr("interval 1 hour"))
        .otherwise(F.col("timestamp")))
    for limits, n in (((0, None), 60), ((7, None), 14), ((0, 600), 40), ((25, 600), 40), ((5, 600), 10)):
        paths = job.order_feed(feed, str(tmp_path), ("name",), *limits)
        assert ordering.read_ordering(spark, paths["name"]).count() == n
        job.check(job.report(spark, str(tmp_path), ("name",), *limits))


def test_large_inputs_are_sorted_one_key_after_the_other(spark, tmp_path):
    records = valid_records(messy_feed(spark, 400))
    paths = job.store_orderings(records, str(tmp_path), ranges=11)
    for key in SORT_KEYS:
        assert positions(ordering.read_ordering(spark, paths[key])) == expected_order(records, key)


def test_check_raises_for_wrong_results(spark, tmp_path):
    paths = job.order_feed(messy_feed(spark, 200), str(tmp_path), ("name",))
    good = job.report(spark, str(tmp_path), ("name",))
    job.check(good)
    other = valid_records(messy_feed(spark, 200, seed=2))
    ordering.store_ordering(other, "name", paths["name"])
    with pytest.raises(RuntimeError, match="differ for"):
        job.check(job.report(spark, str(tmp_path), ("name",)))
    fresh = job.report(spark, str(tmp_path), ("name",))
    shuffled = fresh["sorted_by_name"].withColumn("is_sorted", F.lit(False))
    with pytest.raises(RuntimeError, match="first fall"):
        job.check({"delivery": fresh["delivery"].limit(0), "sorted_by_name": shuffled})


def test_command_line(spark, tmp_path, capsys):
    import main

    main.run(spark, main.arguments(["--generate", "500", "--out", str(tmp_path), "--keys", "id", "name"]))
    printed = capsys.readouterr().out
    assert "sorted_by_name" in printed and "first records by id" in printed
    main.run(spark, main.arguments(["--feed", f"{tmp_path}/feed", "--out", f"{tmp_path}/again", "--max-records", "3"]))
    assert ordering.read_ordering(spark, f"{tmp_path}/again/key=continent").count() == 12
    for wrong in (["--out", "x"], ["--topic", "t", "--out", "x"], ["--feed", "f", "--out", "x", "--keys", "z"]):
        with pytest.raises(SystemExit):
            main.arguments(wrong)
