"""The sortedness check against direct comparison."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions.numbers import floor_div
from feedloom.operators import verify


def stored(spark, values, key="id"):
    kind = "BIGINT" if key == "id" else "STRING"
    return spark.createDataFrame(list(enumerate(values, 1)), f"pos BIGINT, {key} {kind}")


def check(frame, key="id", **options):
    return tuple(verify.sortedness(frame, key, **options).first())


@pytest.mark.parametrize("values, expected", [
    ([1, 2, 3], (3, 0, None, True)),
    ([2, 1], (2, 1, 2, False)),
    ([1, 1, 1], (3, 0, None, True)),
    ([5], (1, 0, None, True)),
    ([], (0, 0, None, True)),
    ([1, 3, 2, 4, 0], (5, 2, 3, False)),
])
def test_literal(spark, values, expected):
    assert check(stored(spark, values)) == expected


@pytest.mark.parametrize("step", [1, 2, 7, 50, 1000])
def test_any_chunk_finds_the_same(spark, step):
    values = [random.Random(3).randrange(50) for _ in range(5)] + sorted(range(60)) + [3, 2, 2, 9]
    falls = [i + 1 for i in range(1, len(values)) if values[i - 1] > values[i]]
    found = check(stored(spark, values), chunk=floor_div(F.col("pos"), step))
    assert found == (len(values), len(falls), falls[0], False)


def test_positions_may_have_holes(spark):
    frame = stored(spark, [1, 2, 5, 4]).withColumn("pos", F.col("pos") * 1_500_000)
    assert check(frame) == (4, 1, 6_000_000, False)


def test_groups_are_checked_apart(spark):
    frame = spark.createDataFrame(
        [(0, 1, 5), (0, 2, 6), (1, 1, 1), (1, 2, 0), (2, 5, 9)], "partition INT, offset BIGINT, id BIGINT")
    assert check(frame, position="offset", within=("partition",)) == (5, 1, 2, False)


def test_bytes_decide(spark):
    assert check(stored(spark, ["Z", "a", "é"], "name"), "name")[3]
    assert not check(stored(spark, ["a", "Z"], "name"), "name")[3]


@pytest.mark.parametrize("values, status", [
    ([1], "not enough data"), ([], "not enough data"), ([1, 2], "sorted"), ([2, 1], "not sorted"),
    (list(range(20)) + [0], "sorted"),
])
def test_head_status(spark, values, status):
    assert verify.check_head(stored(spark, values), "id").first()["status"] == status
