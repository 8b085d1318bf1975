"""Small feeds for tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "value BINARY, partition INT, offset BIGINT, timestamp TIMESTAMP"


def feed_of(spark, lines, partitions=1, seconds=1):
    """Lines (text, bytes or None) as a feed, dealt out to the partitions in turn."""
    rows = []
    for i, line in enumerate(lines):
        data = line.encode() if isinstance(line, str) else line
        rows.append((data, i % partitions, i // partitions, START + dt.timedelta(seconds=seconds * i)))
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumn("value", F.col("value").cast("string"))


def model_parse(line: bytes):
    """What a line must parse to: ``(id, name, address, continent)`` or a reason."""
    parts = line.split(b",", 3)
    if len(parts) < 4:
        return f"missing field {len(parts)}"
    digits = parts[0][1:] if parts[0][:1] in (b"+", b"-") else parts[0]
    if not digits or any(c not in b"0123456789" for c in digits):
        return "bad id"
    number = int(parts[0])
    if not -(2**63) <= number < 2**63:
        return "bad id"
    return (number, *parts[1:])
