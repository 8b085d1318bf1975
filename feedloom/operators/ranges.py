"""Ranges of a sort by bounds that are known already, so that no row is sampled.

A bound is the key of a row: the sort columns, texts as hexadecimal digits of their bytes,
which have the order of the bytes and pass the driver unharmed. There are as many bounds as
ranges. Rows find their range by a binary search in built-in functions.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.contract import sort_columns

_TEXTS = ("name", "continent")


def key_of(key: str) -> Column:
    """A row's place in the order of ``key`` as one comparable value."""
    return F.struct(*[
        (F.hex(F.col(c).cast("binary")) if c in _TEXTS else F.col(c)).alias(c) for c in sort_columns(key)
    ])


def _kind(key: str) -> str:
    kinds = {"id": "bigint", "partition": "int", "offset": "bigint"}
    return "array<struct<" + ",".join(f"{c}:{kinds.get(c, 'string')}" for c in sort_columns(key)) + ">>"


def range_of(key: str, bounds: list) -> Column:
    """How many of the sorted ``bounds`` (rows of ``key_of``) are not above the row."""
    if not bounds:
        return F.lit(0)
    known = F.from_json(F.lit(json.dumps([b.asDict() for b in bounds])), _kind(key))
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    mine = key_of(key)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(known, at + step - 1) <= mine, F.lit(False)), at + step).otherwise(at),
    )


def deal(rows: DataFrame, key: str, bounds: list) -> DataFrame:
    """Rows in the order of ``key``, cut at the bounds: one range is one task's work."""
    dealt = rows.repartitionById(len(bounds) + 1, range_of(key, bounds))
    return dealt.sortWithinPartitions(*sort_columns(key))
