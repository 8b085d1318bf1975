"""The whole job: one scan of a feed, its orderings, and the proof of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.contract import SORT_KEYS, sort_columns
from feedloom.operators import accounting, arrival, verify
from feedloom.operators.intake import parse_feed
from feedloom.operators.ordering import extend_ordering, for_each_key, keyed, read_ordering, store_ordering
from feedloom.operators.sizing import ranges_for, table_options
from feedloom.streaming.drain import drain, drain_feed


def store_parsed(feed: DataFrame, path: str) -> int:
    """Parse a feed once into a table; returns the bytes of its lines.

    Later steps read only the columns they need from it, and they all see the same
    rows, even if the feed has grown meanwhile. The address is left in the line.
    """
    seen = Observation("parsed")
    size = F.coalesce(F.sum(F.octet_length("raw").cast("bigint")), F.lit(0)).alias("bytes")
    parsed = parse_feed(feed).drop("address")
    parsed.observe(seen, size).write.mode("overwrite").options(
        **table_options("raw", "offset")
    ).parquet(path)
    return seen.get["bytes"]


def read_valid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("error").isNull()).drop("error")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    parsed = spark.read.parquet(path).filter(F.col("error").isNotNull())
    return parsed.select("raw", "partition", "offset", "error")


def bounded(records: DataFrame, max_records: int = 0, idle_seconds: int | None = None) -> DataFrame:
    """Records up to each partition's first long silence, and at most so many of them."""
    if idle_seconds is not None:
        records = accounting.idle_cut(records, idle_seconds)
    return arrival.cap_per_partition(records, max_records)


def store_orderings(
    records: DataFrame,
    path: str,
    keys: tuple[str, ...] = SORT_KEYS,
    ranges: int | None = None,
    at_once: int = len(SORT_KEYS),
) -> dict[str, str]:
    """One stored ordering per key; returns where.

    ``at_once`` orderings are made at a time. Together, no executor waits for the
    stragglers of one sort; one after the other, only one sort's shuffle files need disk
    space, which is what to choose for inputs that fill the cluster. ``ranges`` is the
    number of sorted partitions, measured if not given. A failed sort fails the call.
    """
    for key in keys:
        sort_columns(key)
    paths = {key: f"{path}/key={key}" for key in keys}
    for_each_key(lambda key: store_ordering(records, key, paths[key], ranges), keys, at_once)
    return paths


def order_feed(
    feed: DataFrame,
    path: str,
    keys: tuple[str, ...] = SORT_KEYS,
    max_records: int = 0,
    idle_seconds: int | None = None,
    ranges: int | None = None,
    at_once: int = len(SORT_KEYS),
) -> dict[str, str]:
    """Parse a feed once and store every ordering of it under ``path``.

    ``ranges`` is measured from the bytes of the lines if it is not given.
    """
    spark = feed.sparkSession
    raw_bytes = store_parsed(feed, f"{path}/parsed")
    records = bounded(read_valid(spark, f"{path}/parsed"), max_records, idle_seconds)
    return store_orderings(records, path, keys, ranges or ranges_for(raw_bytes), at_once)


def three_orderings(feed: DataFrame, path: str) -> DataFrame:
    """``key, pos, raw`` for all keys."""
    paths = order_feed(feed, path)
    return keyed({key: read_ordering(feed.sparkSession, p) for key, p in paths.items()})


def report(
    spark: SparkSession,
    path: str,
    keys: tuple[str, ...] = SORT_KEYS,
    max_records: int = 0,
    idle_seconds: int | None = None,
) -> dict[str, DataFrame]:
    """What to check after ``order_feed`` with the same settings."""
    orderings = {key: read_ordering(spark, f"{path}/key={key}") for key in keys}
    records = bounded(read_valid(spark, f"{path}/parsed"), max_records, idle_seconds)
    return {
        "intake": accounting.intake_stats(spark.read.parquet(f"{path}/parsed")),
        "delivery": accounting.reconcile(records, keyed(orderings), keys),
        **{
            f"sorted_by_{key}": verify.sortedness(stored, key, chunk=F.col("bucket"), numbers=True)
            for key, stored in orderings.items()
        },
    }


def check(reports: dict[str, DataFrame]) -> None:
    """Raise unless every ordering is complete and in order."""
    wrong = [row["key"] for row in reports["delivery"].filter(~F.col("contents_match")).collect()]
    if wrong:
        raise RuntimeError(f"produced and delivered records differ for {sorted(wrong)}")
    for name, checked in reports.items():
        if name.startswith("sorted_by_"):
            row = checked.first()
            if not row["is_sorted"]:
                raise RuntimeError(f"not {name}: first fall at position {row['first_bad_pos']}")
            if not row["is_numbered"]:
                raise RuntimeError(f"not {name}: positions are doubled or missing")


def order_stream(
    feed: DataFrame,
    path: str,
    keys: tuple[str, ...] = SORT_KEYS,
    max_records: int = 0,
    idle_seconds: int | None = None,
    ranges: int | None = None,
    at_once: int = len(SORT_KEYS),
) -> dict[str, str]:
    """``order_feed`` for all that a stream holds: parsed once while it is drained.

    Rejects stay in the parsed rows, so ``report`` works as it does for ``order_feed``.
    """
    spark = feed.sparkSession
    drain_feed(feed, f"{path}/parsed", f"{path}/offsets")
    size = F.sum(F.octet_length("raw").cast("bigint"))
    raw_bytes = spark.read.parquet(f"{path}/parsed").agg(size).first()[0] or 0
    records = bounded(read_valid(spark, f"{path}/parsed"), max_records, idle_seconds)
    return store_orderings(records, path, keys, ranges or ranges_for(raw_bytes), at_once)


def extend_orderings(
    records: DataFrame, path: str, keys: tuple[str, ...] = SORT_KEYS, batch: int | None = None
) -> dict[str, str]:
    """Add records to one stored ordering per key, or store the first ones; returns where.

    With ``batch``, a growing number, a key that had the batch already is left alone, so a
    batch that failed half-way can run again.
    """
    paths = {key: f"{path}/key={key}" for key in keys}
    for_each_key(lambda key: extend_ordering(records, key, paths[key], batch), keys)
    return paths


def order_stream_by_batches(
    feed: DataFrame, path: str, keys: tuple[str, ...] = SORT_KEYS
) -> dict[str, str]:
    """Take in all that a stream holds, each micro-batch at once into the stored orderings.

    The orderings are whole after each batch; a later call goes on where this one ends. The
    batch is parsed into a table first, whose folder is overwritten if it runs again.
    """

    def extend(batch: DataFrame, number: int) -> None:
        where = f"{path}/parsed/batch_id={number}"
        store_parsed(batch, where)
        extend_orderings(read_valid(batch.sparkSession, where), path, keys, number)

    drain(feed, extend, f"{path}/offsets")
    return {key: f"{path}/key={key}" for key in keys}


def check_published(records: DataFrame, published: dict[str, DataFrame]) -> None:
    """Raise unless what was read back (``raw``) from each key's target is what was ordered.

    A write task that ran twice shows as lines delivered too often.
    """
    delivered = keyed({
        key: came.select(F.lit(None).cast("bigint").alias("pos"), "raw") for key, came in published.items()
    })
    check({"delivery": accounting.reconcile(records, delivered, tuple(published))})
