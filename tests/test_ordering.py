"""Total orders: positions, ties, skew, runs and merges."""

import random

import pytest
from helpers import feed_of
from pyspark.sql import functions as F

from feedloom.contract import SORT_KEYS, sort_columns
from feedloom.operators import ordering
from feedloom.operators.intake import valid_records
from feedloom.operators.runs import sorted_runs
from feedloom.operators.sizing import ranges_for
from feedloom.operators.verify import sortedness
from feedloom.sinks.files import write_ordered_lines, write_runs
from feedloom.sinks.kafka import ordered_messages
from feedloom.sources.files import scan_lines


def messy_feed(spark, n=3000, partitions=4, seed=1):
    """Few names, one of them on a third of the rows; some rows malformed, some doubled."""
    rng = random.Random(seed)
    lines = []
    for i in range(n):
        name = "hot" if rng.random() < 0.34 else rng.choice(["Ann", "bob", "é", "Zoe", ""])
        lines.append(f"{rng.randrange(n // 2)},{name},street,{rng.choice(['Asia', 'Europe', 'Africa'])}")
        if rng.random() < 0.05:
            lines[-1] = lines[-1].replace(",", ";", 2)
    return feed_of(spark, lines, partitions)


def expected_order(records, key):
    rows = [row.asDict() for row in records.collect()]

    def value(column, row):
        return row[column].encode() if isinstance(row[column], str) else row[column]

    rows.sort(key=lambda row: tuple(value(c, row) for c in sort_columns(key)))
    return [(i + 1, row["raw"], row["partition"], row["offset"]) for i, row in enumerate(rows)]


def positions(frame):
    return sorted((r["pos"], r["raw"], r["partition"], r["offset"]) for r in frame.collect())


@pytest.mark.parametrize("key", SORT_KEYS)
@pytest.mark.parametrize("ranges", [None, 1, 5, 16])
def test_positions_for_any_number_of_ranges(spark, key, ranges):
    records = valid_records(messy_feed(spark))
    assert positions(ordering.sorted_by(records, key, ranges)) == expected_order(records, key)


@pytest.mark.parametrize("width", [1, 4, 16])
def test_positions_for_any_shuffle_width(spark, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        records = valid_records(messy_feed(spark))
        assert positions(ordering.sorted_by(records, "name")) == expected_order(records, "name")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_key_value_is_spread_over_ranges(spark):
    lines = [f"{i},same,street,Asia" for i in range(4000)]
    records = valid_records(feed_of(spark, lines, 4))
    sizes = ordering.in_order(records, "continent", 8).groupBy(F.spark_partition_id()).count()
    counts = [row["count"] for row in sizes.collect()]
    assert len(counts) == 8 and max(counts) < 1000


def test_literal_orders(spark):
    def names(lines, key, column):
        records = valid_records(feed_of(spark, lines))
        return [r[column] for r in sorted(ordering.sorted_by(records, key).collect())]

    assert names(["70,k,s,Oz", "-5,k,s,Oz", "12,k,s,Oz"], "id", "id") == [-5, 12, 70]
    people = ["8,Mira,s,Oz", "4,Anton,s,Oz", "6,Jule,s,Oz"]
    assert names(people, "name", "name") == ["Anton", "Jule", "Mira"]
    places = ["11,k,s,Europe", "12,k,s,Asia", "13,k,s,Asia", "14,k,s,Africa"]
    assert names(places, "continent", "continent") == ["Africa", "Asia", "Asia", "Europe"]


def test_strings_are_ordered_by_their_bytes(spark):
    names = [b"\xff", "é".encode(), b"a", b"Z", b"B", b"b", "￿".encode(), "\U0001f600".encode()]
    records = valid_records(feed_of(spark, [b"1," + n + b",x,y" for n in names]))
    rows = ordering.sorted_by(records, "name").select("pos", F.col("name").cast("binary"))
    assert [bytes(name) for _, name in sorted(rows.collect())] == sorted(names)


def test_unknown_key_is_an_error(spark):
    records = valid_records(feed_of(spark, ["1,a,b,c"]))
    for call in (
        lambda: ordering.sorted_by(records, "address"),
        lambda: ordering.head_of_ordering(records, "x"),
        lambda: sortedness(records, "x", "offset"),
        lambda: sorted_runs(records, keys=("x",)),
    ):
        with pytest.raises(ValueError, match="unknown sort key"):
            call()


def test_no_records(spark):
    records = valid_records(feed_of(spark, ["bad"]))
    assert ordering.sorted_by(records, "id").count() == 0
    assert ordering.head_of_ordering(records, "id").count() == 0


def test_heads_agree(spark, tmp_path):
    records = valid_records(messy_feed(spark))
    ordering.store_ordering(records, "name", str(tmp_path), 7)
    for n in (0, 1, 20, 1000, 10_000):
        stored = positions(ordering.read_head(spark, str(tmp_path), n))
        assert stored == positions(ordering.head_of_ordering(records, "name", n))
        assert stored == expected_order(records, "name")[:n]


def test_head_is_a_top_n_not_a_sort(spark):
    records = valid_records(messy_feed(spark, 100))
    plan = ordering.head_of_ordering(records, "name")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_unfinished_ordering_cannot_be_read(spark, tmp_path, monkeypatch):
    """Neither the first at a place nor one that replaces an older one."""
    records, path = valid_records(messy_feed(spark, 50)), str(tmp_path)

    def broken(rows, where):
        raise RuntimeError("lost the driver")

    ordering.store_ordering(records, "id", path)
    assert ordering.read_ordering(spark, path).count() == records.count()
    monkeypatch.setattr(ordering, "_write_pieces", broken)
    with pytest.raises(RuntimeError, match="lost the driver"):
        ordering.store_ordering(records.limit(10), "id", path)
    monkeypatch.undo()
    with pytest.raises(Exception, match="not finished"):
        ordering.read_ordering(spark, path).collect()
    with pytest.raises(Exception, match="not finished"):
        ordering.read_head(spark, path).collect()
    with pytest.raises(RuntimeError, match="not finished"):
        ordering.read_ordering(spark, path).count()
    with pytest.raises(RuntimeError, match="not finished"):
        ordered_messages(ordering.read_ordering(spark, path), "id")
    ordering.store_ordering(records, "id", path)
    assert positions(ordering.read_ordering(spark, path)) == expected_order(records, "id")


@pytest.mark.parametrize("chunk", [1, 7, 100, 1_000_000])
def test_runs_for_any_chunk(spark, chunk):
    records = valid_records(messy_feed(spark, 600))
    found = sorted_runs(records, 50, chunk_offsets=chunk).collect()
    rows = [row.asDict() for row in records.collect()]
    expected = []
    for partition in range(4):
        arrived = sorted((r for r in rows if r["partition"] == partition), key=lambda r: r["offset"])
        for run in range(-(-len(arrived) // 50)):
            batch = arrived[run * 50:(run + 1) * 50]
            for key in SORT_KEYS:
                order = sorted(batch, key=lambda r: tuple(
                    r[c].encode() if isinstance(r[c], str) else r[c] for c in sort_columns(key)))
                expected += [(key, partition, run, i + 1, r["raw"], r["offset"]) for i, r in enumerate(order)]
    assert sorted(
        (r["key"], r["partition"], r["run"], r["pos_in_run"], r["raw"], r["offset"]) for r in found
    ) == sorted(expected)


def test_many_runs_per_partition_merge_into_one_order(spark, tmp_path):
    """Several runs in one input must not be taken for one."""
    records = valid_records(messy_feed(spark))
    write_runs(sorted_runs(records, 20), str(tmp_path))
    runs = spark.read.parquet(str(tmp_path))
    assert runs.filter("key = 'name'").agg(F.countDistinct("run")).first()[0] > 10
    for key in SORT_KEYS:
        merged = ordering.sorted_by(ordering.merge_runs([runs.filter(F.col("key") == key)]), key)
        assert positions(merged) == expected_order(records, key)
        assert sortedness(merged, key).first()["inversions"] == 0


def test_merge_keeps_equal_rows(spark):
    records = valid_records(feed_of(spark, ["1,a,b,c"] * 3))
    merged = ordering.merge_runs([records, records])
    assert sorted(r["pos"] for r in ordering.sorted_by(merged, "id").collect()) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(ValueError, match="no runs"):
        ordering.merge_runs([])


def test_bad_rows_and_newlines_do_not_cost_their_neighbours(spark):
    lines = []
    for i in range(500):
        lines += [f"{i},n{i % 7},a\nb,c", "broken", f"{i},n,\r\n,x"]
    records = valid_records(feed_of(spark, lines, 3))
    assert positions(ordering.sorted_by(records, "name")) == expected_order(records, "name")
    assert records.count() == 1000


def test_ordered_lines_are_in_order_across_files(spark, tmp_path):
    records = valid_records(messy_feed(spark, 500))
    write_ordered_lines(records, "name", str(tmp_path), 4)
    lines = [
        line
        for file in sorted(tmp_path.glob("part-*"))
        for line in file.read_bytes().decode().split("\n")[:-1]
    ]
    assert lines == [raw for _, raw, _, _ in expected_order(records, "name")]
    assert sorted(r["line"] for r in scan_lines(spark, str(tmp_path)).collect()) == sorted(lines)


def test_messages_hold_ranges_in_order(spark):
    records = valid_records(messy_feed(spark, 500))
    rows = ordered_messages(records, "id", 4).collect()
    assert [r["partition"] for r in rows] == sorted(r["partition"] for r in rows)
    assert {r["partition"] for r in rows} <= set(range(4))
    assert [r["value"] for r in rows] == [raw for _, raw, _, _ in expected_order(records, "id")]


def test_wide_sorts_get_their_own_number_of_ranges(spark):
    assert [ranges_for(n * 1024**2) for n in (0, 1, 1024, 1024**2, 100 * 1024**2)] == [1, 4, 128, 4096, 40_960]
