"""Column contracts and fixed values shared by every operator.

A *feed* is any DataFrame with ``value, partition, offset, timestamp`` where
``(partition, offset)`` is unique. A *record* is one valid, parsed feed row.
"""

from __future__ import annotations

FEED_COLUMNS = ("value", "partition", "offset", "timestamp")
FEED_SCHEMA = "value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"

RECORD_COLUMNS = (
    "raw", "id", "name", "address", "continent", "partition", "offset", "timestamp",
)

# The sort keys, the feed alphabets and the continents.
SORT_KEYS = ("id", "name", "continent")
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ADDRESS_CHARACTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "
CONTINENTS = ("North America", "Asia", "South America", "Europe", "Africa", "Australia")

# Reject reasons, in order of precedence.
MISSING_FIELD_1 = "missing field 1"
MISSING_FIELD_2 = "missing field 2"
MISSING_FIELD_3 = "missing field 3"
BAD_ID = "bad id"
REASONS = (MISSING_FIELD_1, MISSING_FIELD_2, MISSING_FIELD_3, BAD_ID)

# Default sizes of batches and sorted runs.
BATCH_SIZE = 2000
FLUSH_SIZE = 2000
HEAD_SIZE = 20


def sort_columns(key: str) -> list[str]:
    """Columns that order a feed by ``key``.

    The id and then the unique feed position break ties, so the order is total.
    It also means that a range shuffle can cut anywhere, even inside one heavily
    repeated key value.
    """
    if key not in SORT_KEYS:
        raise ValueError(f"unknown sort key {key!r}; expected one of {SORT_KEYS}")
    return list(dict.fromkeys([key, "id", "partition", "offset"]))
