"""Exact integer arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(number: Column, step: int) -> Column:
    """``number`` divided by ``step``, rounded down, without a detour through doubles."""
    if step < 1:
        raise ValueError("the step must be positive")
    whole = number - F.pmod(number, F.lit(step))
    return F.call_function("div", whole, F.lit(step)).cast("bigint")
