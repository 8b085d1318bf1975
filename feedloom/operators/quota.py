"""Split a numbered table among workers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.numbers import floor_div


def quota_sizes(total: int, workers: int) -> list[int]:
    """Records per worker: an equal share each, the rest on top for the first."""
    if workers < 1 or total < 0:
        raise ValueError("need at least one worker and no negative total")
    share, rest = divmod(total, workers)
    return [share + rest] + [share] * (workers - 1)


def with_shard(rows: DataFrame, total: int, workers: int) -> DataFrame:
    """Add the worker, counted from 0, that gets the row at position ``pos`` of ``total``."""
    first, *others = quota_sizes(total, workers)
    share = others[0] if others else 0
    later = floor_div(F.col("pos") - (first - share) - 1, max(share, 1))
    return rows.withColumn(
        "shard", F.when(F.col("pos") <= first, F.lit(0)).otherwise(later).cast("int")
    )
