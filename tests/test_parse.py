"""The strict parser: literal cases, odd bytes, and a model over random lines."""

import pytest
from helpers import feed_of, model_parse
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions.lines import format_line
from feedloom.operators.intake import parse_feed, rejects, valid_records

LITERAL = [
    ("806,Ilse M,Am Ring 4,Asia", (806, "Ilse M", "Am Ring 4", "Asia")),
    ("806Ilse,Am Ring,Asia", "missing field 3"),
    ("806,Ilse", "missing field 2"),
    ("o6,Ilse,Am Ring,Asia", "bad id"),
    ("-9,Ilse,Am Ring,Asia", (-9, "Ilse", "Am Ring", "Asia")),
    ("5,,,", (5, "", "", "")),
    ("5,a,b,c,d,", (5, "a", "b", "c,d,")),
    ("5, a,b , c ", (5, " a", "b ", " c ")),
    ("", "missing field 1"),
    (None, "missing field 1"),
    ("123", "missing field 1"),
    ("x", "missing field 1"),
    (",,,", "bad id"),
    ("+,a,b,c", "bad id"),
    ("+5,a,b,c", (5, "a", "b", "c")),
    (" 7,a,b,c", "bad id"),
    ("7 ,a,b,c", "bad id"),
    ("7\n,a,b,c", "bad id"),
    ("1.5,a,b,c", "bad id"),
    ("1_0,a,b,c", "bad id"),
    ("5L,a,b,c", "bad id"),
    ("1e3,a,b,c", "bad id"),
    ("١,a,b,c", "bad id"),
    ("9223372036854775807,a,b,c", (2**63 - 1, "a", "b", "c")),
    ("9223372036854775808,a,b,c", "bad id"),
    ("-9223372036854775808,a,b,c", (-(2**63), "a", "b", "c")),
    ("-9223372036854775809,a,b,c", "bad id"),
    ("00000000000000000000000005,a,b,c", (5, "a", "b", "c")),
    ("1,a\nb,c\rd,e\r\n", (1, "a\nb", "c\rd", "e\r\n")),
    ("1,é\U0001f600,ß,日本,語", (1, "é\U0001f600", "ß", "日本,語")),
]


def parsed_rows(spark, lines):
    frame = parse_feed(feed_of(spark, lines)).select(
        "offset", F.col("raw").cast("binary").alias("raw"), "id",
        *[F.col(c).cast("binary").alias(c) for c in ("name", "address", "continent")], "error",
    )
    return [
        row["error"] if row["error"] is not None
        else (row["id"], *(bytes(row[c]) for c in ("name", "address", "continent")))
        for row in sorted(frame.collect(), key=lambda row: row["offset"])
    ]


def as_bytes(expected):
    if isinstance(expected, str):
        return expected
    return (expected[0], *(field.encode() for field in expected[1:]))


def test_literal_cases(spark):
    found = parsed_rows(spark, [line for line, _ in LITERAL])
    assert found == [as_bytes(expected) for _, expected in LITERAL]


def test_broken_utf8_keeps_its_bytes(spark):
    lines = [
        b"7,\xe2,addr\xe2,tail\xff,x", b"7,\xff\xfe,\xe2,\xe2,", b"1,\xf0\x9f,\xf0,\xf0\x9f\x98,\x80",
        b"\xe2,a,b,c", b"1\xe2,a,b,c", b"\xe2", b"1,\xe2", b"1,a,\xe2",
    ]
    assert parsed_rows(spark, lines) == [model_parse(line) for line in lines]


def test_raw_is_unchanged_and_rows_are_split_in_two(spark):
    lines = [line for line, _ in LITERAL]
    feed = feed_of(spark, lines, partitions=3)
    good = {(r["partition"], r["offset"]): r["raw"] for r in valid_records(feed).collect()}
    bad = {(r["partition"], r["offset"]): r["raw"] for r in rejects(feed).collect()}
    assert not good.keys() & bad.keys()
    assert {**good, **bad} == {(i % 3, i // 3): line or "" for i, line in enumerate(lines)}


@pytest.fixture(scope="module")
def parse_many(spark):
    return lambda lines: parsed_rows(spark, lines)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="01789+-, aé\n\r;x", max_size=14), min_size=40, max_size=80))
def test_random_lines_follow_the_model(parse_many, lines):
    assert parse_many(lines) == [model_parse(line.encode()) for line in lines]


def test_formatting_is_the_inverse(spark):
    lines = ["1,a,b,c", "-3,,x y,p,q"]
    records = valid_records(feed_of(spark, lines))
    again = records.select(format_line(*[F.col(c) for c in ("id", "name", "address", "continent")]))
    assert sorted(row[0] for row in again.collect()) == sorted(lines)
