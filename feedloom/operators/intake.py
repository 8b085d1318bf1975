"""Turn feed lines into records, and set the malformed ones aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.contract import BAD_ID, MISSING_FIELD_1, MISSING_FIELD_2, MISSING_FIELD_3
from feedloom.functions import lines

PLACE = ("partition", "offset", "timestamp")


def _cut(feed: DataFrame) -> DataFrame:
    """The line, its first one, two and three fields, and its id.

    Each is a column of its own, used more than once later. Above a filter Catalyst may
    write such an expression out again where it is used, so some are computed twice for a
    row. A message without a value is an empty line.
    """
    raw = F.col("raw")
    return (
        feed.select(F.coalesce("value", F.lit("")).alias("raw"), *PLACE)
        .withColumns({f"head{n}": lines.head(raw, n) for n in (1, 2, 3)})
        .withColumn("id", lines.strict_id(F.col("head1")))
    )


def _lacks_comma(n: int) -> Column:
    return F.octet_length(f"head{n}") == F.octet_length("raw")


def _is_valid() -> Column:
    return ~_lacks_comma(3) & F.col("id").isNotNull()


def _error() -> Column:
    return (
        F.when(_is_valid(), None)
        .when(_lacks_comma(1), MISSING_FIELD_1)
        .when(_lacks_comma(2), MISSING_FIELD_2)
        .when(_lacks_comma(3), MISSING_FIELD_3)
        .otherwise(BAD_ID)
    )


def _fields() -> dict[str, Column]:
    return {
        "id": F.col("id"),
        "name": lines.last_field(F.col("head2")),
        "address": lines.last_field(F.col("head3")),
        "continent": lines.rest(F.col("raw"), F.col("head3")),
    }


def parse_feed(feed: DataFrame) -> DataFrame:
    """Every feed row with its fields, or with the reason it has none."""
    cut = _cut(feed).withColumn("valid", _is_valid())
    fields = [F.when(F.col("valid"), field).alias(name) for name, field in _fields().items()]
    return cut.select("raw", *fields, _error().alias("error"), *PLACE)


def valid_records(feed: DataFrame) -> DataFrame:
    """The records of a feed; malformed rows are left out one by one."""
    fields = [field.alias(name) for name, field in _fields().items()]
    return _cut(feed).filter(_is_valid()).select("raw", *fields, *PLACE)


def rejects(feed: DataFrame) -> DataFrame:
    """The malformed rows, with their place in the feed and the reason."""
    return _cut(feed).filter(~_is_valid()).select(
        "raw", "partition", "offset", _error().alias("error")
    )
