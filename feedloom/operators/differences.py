"""Which lines were lost or delivered too often: a tree of fingerprints by hash prefix.

Lines are hashed. Both sides are counted and fingerprinted per prefix of the hash; only
prefixes that differ are opened at the next level, and only lines under the last differing
prefixes are compared as lines. Equal sides cost one aggregation each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.lines import fingerprint
from feedloom.operators.sizing import stored_rows

#: Bits of the hash by which each level of the tree is finer than the one above it.
LEVELS = (12, 12)


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("raw"), 64 - bits)


def _prints(rows: DataFrame, bits: int, side: str) -> DataFrame:
    return rows.groupBy("key", _prefix(bits).alias("prefix")).agg(
        F.count("*").alias(f"{side}_n"), fingerprint(F.col("raw")).alias(f"{side}_print")
    )


def _under(rows: DataFrame, prefixes: DataFrame, bits: int) -> DataFrame:
    """Rows under known prefixes; the table of prefixes is stored, so its size is known."""
    return rows.withColumn("prefix", _prefix(bits)).join(prefixes, ["key", "prefix"], "left_semi").select("key", "raw")


def differing_prefixes(
    produced: DataFrame, delivered: DataFrame, keys: tuple[str, ...], levels: tuple[int, ...] = LEVELS
) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """key, prefix of the last level that differ; both sides' rows below, and the bits.

    ``produced`` has ``raw``, ``delivered`` has ``key, raw``.
    """
    names = F.array(*[F.lit(key) for key in keys])
    made, came = produced.select("raw"), delivered.select("key", "raw").filter(F.col("key").isin(*keys))
    bits, found = 0, None
    for more in levels:
        bits += more
        if found is None:
            # What was produced is the same for every key: multiply the counts, not the lines.
            left = _prints(made.withColumn("key", F.lit("")), bits, "made").drop("key").withColumn("key", F.explode(names))
        else:
            left = _prints(made, bits, "made")
        both = left.join(_prints(came, bits, "came"), ["key", "prefix"], "full")
        same = F.coalesce(
            (F.col("made_n") == F.col("came_n")) & (F.col("made_print") == F.col("came_print")), F.lit(False)
        )
        wide = made.withColumn("key", F.explode(names)) if found is None else made
        found, _ = stored_rows(both.filter(~same).select("key", "prefix"), "differing-prefixes")
        made, came = _under(wide, found, bits), _under(came, found, bits)
    return found, made, came, bits


def reconcile_diff(
    produced: DataFrame, delivered: DataFrame, keys: tuple[str, ...], levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """key, raw, missing, doubled: how often each line was lost, or delivered too often."""
    _, made, came, _ = differing_prefixes(produced, delivered, keys, levels)
    sides = made.withColumn("n", F.lit(1)).unionByName(came.withColumn("n", F.lit(-1)))
    balance = F.sum("n")
    none = F.lit(0)
    return sides.groupBy("key", "raw").agg(balance.alias("n")).filter("n <> 0").select(
        "key", "raw",
        F.greatest(F.col("n"), none).cast("bigint").alias("missing"),
        F.greatest(-F.col("n"), none).cast("bigint").alias("doubled"),
    )
