"""Every operator as a query on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import scratch
from feedloom.contract import SORT_KEYS
from feedloom.operators import accounting, arrival, differences, offsets, ordering, quota, runs, verify
from feedloom.operators.intake import parse_feed, rejects, valid_records
from feedloom.operators.sizing import rows_per_file, stored_rows
from feedloom.plans import job
from feedloom.sinks import resumed
from feedloom.sinks.files import write_feed, write_lines, write_runs, write_stored_lines
from feedloom.sources import synthetic, tables
from feedloom.sources.files import lines_feed, read_ordered_lines, scan_feed, scan_lines, stream_feed
from feedloom.streaming import drain, idle, rates, replay

# Parameters the queries share with their SQL counterparts.
SEED = 42
CAP = 1000
EXPECTED = 3376
BATCH = 2000
MILESTONE = 500
DAY_SECONDS = 86_400
HOUR_SECONDS = 3_600
EVENTS_START = "2024-01-01 00:00:00"
EVENTS_LATE_START = "2024-01-10 00:00:00"
FAR_DAYS = 3_000
EVENTS_AS_OF = "2024-01-31 00:00:00"
EVENTS_TARGET = 12_000
WORKERS = 7
FLUSH = 2000
FAULT_EVERY = 1000
HEAD_OFFSETS = 400
STREAM_FILE_ROWS = 3000
STREAM_FILES = 100
DRAINS = 3
SLICES = 4
LATE_SECONDS = 86_400
AGAIN_EVERY = 700
RATE_SLICES = 8
HELD_EVERY = 50
HELD_SLICES = 3
STRETCHES = 4

Query = Callable[[SparkSession, str], DataFrame]


def _moment(text: str):
    return F.lit(text).cast("timestamp")


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_records(tables.dirty_orders_feed(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_records(tables.events_feed(spark, sf_dir))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), parts)


def _generate_feed(spark, sf_dir):
    orders = spark.read.schema("o_orderkey BIGINT").parquet(f"{sf_dir}/orders.parquet")
    return synthetic.records_for(orders.select((F.col("o_orderkey") + 1).alias("id")), SEED)


def _scan_feed(spark, sf_dir):
    path = scratch.new_path(spark, "scan-feed")
    write_feed(tables.dirty_orders_feed(spark, sf_dir), path)
    return scan_feed(spark, path)


def _stream_drain(spark, sf_dir):
    path = scratch.new_path(spark, "drain")
    drain.drain_feed(tables.dirty_orders_stream(spark, sf_dir), f"{path}/rows", f"{path}/offsets")
    return drain.read_batches(spark, f"{path}/rows")


def _scan_lines(spark, sf_dir):
    path = scratch.new_path(spark, "lines")
    write_lines(tables.documents_feed(spark, sf_dir), path)
    return scan_lines(spark, path)


def _cap_per_partition(spark, sf_dir):
    return arrival.cap_per_partition(_dirty(spark, sf_dir), CAP)


def _parse_feed(spark, sf_dir):
    return parse_feed(tables.dirty_orders_feed(spark, sf_dir))


def _parse_documents(spark, sf_dir):
    return parse_feed(tables.documents_feed(spark, sf_dir)).drop("timestamp")


def _rejects(spark, sf_dir):
    return rejects(tables.dirty_orders_feed(spark, sf_dir))


def _sorted_by(key: str) -> Query:
    return lambda spark, sf_dir: ordering.sorted_by(_dirty(spark, sf_dir), key)


def _sorted_runs(spark, sf_dir):
    return runs.sorted_runs(_dirty(spark, sf_dir), FLUSH).select(
        "key", "partition", "run", "pos_in_run", "raw"
    )


def _merge_runs(spark, sf_dir):
    path = scratch.new_path(spark, "runs")
    write_runs(runs.sorted_runs(_dirty(spark, sf_dir), FLUSH), f"{path}/runs")
    stored = spark.read.parquet(f"{path}/runs")
    even = F.col("partition") % 2 == 0
    both = ordering.merge_runs([stored.filter(even), stored.filter(~even)])
    paths = runs.merge_all({key: both.filter(F.col("key") == key) for key in SORT_KEYS}, path)
    return ordering.keyed({key: ordering.read_ordering(spark, p) for key, p in paths.items()})


def _three_orderings(spark, sf_dir):
    feed = tables.dirty_orders_feed(spark, sf_dir)
    return job.three_orderings(feed, scratch.new_path(spark, "orderings"))


def _head_of_ordering(spark, sf_dir):
    records = _dirty(spark, sf_dir)
    return ordering.keyed({key: ordering.head_of_ordering(records, key) for key in SORT_KEYS})


def _intake_stats(spark, sf_dir):
    return accounting.intake_stats(parse_feed(tables.dirty_orders_feed(spark, sf_dir)))


def _topic_size(spark, sf_dir):
    return accounting.topic_size(tables.dirty_orders_feed(spark, sf_dir))


def _throughput(spark, sf_dir):
    return accounting.throughput(_events(spark, sf_dir), DAY_SECONDS, _moment(EVENTS_START))


def _throughput_dirty(spark, sf_dir):
    place = F.col("offset")
    odd = (
        F.when(place % 97 == 0, F.lit(None).cast("timestamp"))
        .when(place % 101 == 1, F.col("timestamp") + F.expr(f"INTERVAL {FAR_DAYS} DAY"))
        .otherwise(F.col("timestamp"))
    )
    rows = _events(spark, sf_dir).withColumn("timestamp", odd)
    return accounting.throughput(rows, DAY_SECONDS, _moment(EVENTS_LATE_START))


def _milestones(spark, sf_dir):
    return arrival.milestones(_events(spark, sf_dir), MILESTONE)


def _completion_summary(spark, sf_dir):
    return accounting.completion_summary(_events(spark, sf_dir), EVENTS_TARGET)


def _reconcile(spark, sf_dir):
    path = scratch.new_path(spark, "reconcile")
    job.order_feed(tables.dirty_orders_feed(spark, sf_dir), path)
    return job.report(spark, path)["delivery"]


def _liveness(spark, sf_dir):
    return accounting.liveness(_events(spark, sf_dir), _moment(EVENTS_AS_OF), HOUR_SECONDS)


def _verify_sorted(spark, sf_dir):
    path = scratch.new_path(spark, "verify")
    job.order_feed(tables.dirty_orders_feed(spark, sf_dir), path)
    stored = job.report(spark, path)
    arrived = job.read_valid(spark, f"{path}/parsed")
    parts = []
    for key in SORT_KEYS:
        by_offset = verify.sortedness(arrived, key, "offset", ("partition",))
        in_place = stored[f"sorted_by_{key}"].drop("is_numbered")
        for subject, checked in (("ordering", in_place), ("arrival", by_offset)):
            parts.append(checked.select(F.lit(subject).alias("subject"), F.lit(key).alias("key"), "*"))
    return _union(parts)


def _verify_head(spark, sf_dir):
    path = scratch.new_path(spark, "heads")
    paths = job.order_feed(tables.dirty_orders_feed(spark, sf_dir), path)
    return _union([
        verify.check_head(ordering.read_head(spark, p), key) for key, p in paths.items()
    ])


def _faulty_orderings(spark, sf_dir):
    """An ordering per key: some rows lost, some doubled, or, with the number of rows as it
    was, the first of each pair of neighbours in the place of both. Positions stay."""
    path = scratch.new_path(spark, "faults")
    paths = job.order_feed(tables.dirty_orders_feed(spark, sf_dir), path)
    good = {key: ordering.read_ordering(spark, p) for key, p in paths.items()}
    here = F.col("pos") % FAULT_EVERY == 0
    even = ordering.total(spark, paths["continent"]) // 2 * 2
    kept = good["continent"].filter((F.col("pos") % 2 == 1) | (F.col("pos") > even))
    return path, {
        "id": good["id"].filter(~here),
        "name": good["name"].unionByName(good["name"].filter(here)),
        "continent": kept.unionByName(kept.filter(F.col("pos") <= even)),
    }


def _reconcile_faults(spark, sf_dir):
    path, faulty = _faulty_orderings(spark, sf_dir)
    produced = job.read_valid(spark, f"{path}/parsed")
    return accounting.reconcile(produced, ordering.keyed(faulty), SORT_KEYS)


def _verify_faults(spark, sf_dir):
    _, faulty = _faulty_orderings(spark, sf_dir)
    return _union([
        verify.sortedness(frame, key, numbers=True).select(F.lit(key).alias("key"), "*")
        for key, frame in faulty.items()
    ])


def _verify_head_faults(spark, sf_dir):
    arrived = _dirty(spark, sf_dir).filter("partition = 0").withColumn("pos", F.col("offset"))
    parts = []
    for key in SORT_KEYS:
        for subject, n in (("arrival", HEAD_OFFSETS), ("one row", 1)):
            first = ordering.head_of_ordering(arrived, "id", 1).select("offset")
            head = arrived if n > 1 else arrived.join(F.broadcast(first), "offset", "left_semi")
            checked = verify.check_head(head, key, HEAD_OFFSETS)
            parts.append(checked.select(F.lit(subject).alias("subject"), "*"))
    return _union(parts)


def _idle_cut(spark, sf_dir):
    return accounting.idle_cut(_events(spark, sf_dir), HOUR_SECONDS)


def _expected_count(spark, sf_dir):
    kept = arrival.expected_count(_dirty(spark, sf_dir), EXPECTED)
    return kept.select("partition", "offset", "id", "complete")


def _fixed_batches(spark, sf_dir):
    return arrival.fixed_batches(tables.orders_feed(spark, sf_dir), BATCH)


def _shard_quota(spark, sf_dir):
    return _shards(spark, tables.orders_feed(spark, sf_dir))


def _shard_quota_dirty(spark, sf_dir):
    return _shards(spark, tables.dirty_orders_feed(spark, sf_dir))


def _shards(spark, feed):
    path = scratch.new_path(spark, "quota")
    ordering.store_ordering(valid_records(feed), "id", path)
    placed = ordering.read_ordering(spark, path)
    return (
        quota.with_shard(placed, ordering.total(spark, path), WORKERS)
        .groupBy("shard")
        .agg(
            F.count("*").alias("records"),
            F.min("pos").alias("first_pos"),
            F.max("pos").alias("last_pos"),
        )
    )


def _stream_sort(spark, sf_dir):
    path = scratch.new_path(spark, "stream-sort")
    write_feed(tables.dirty_orders_feed(spark, sf_dir), f"{path}/feed")
    paths = drain.stream_sort(stream_feed(spark, f"{path}/feed"), path)
    return ordering.keyed({key: ordering.read_ordering(spark, p) for key, p in paths.items()})


def _publish_ordering(spark, sf_dir):
    path = scratch.new_path(spark, "published")
    ordering.store_ordering(valid_records(tables.documents_feed(spark, sf_dir)), "name", path)
    return ordering.read_ordering(spark, path).drop("bucket")


def _publish_lines(spark, sf_dir):
    path = scratch.new_path(spark, "published-lines")
    paths = job.order_feed(tables.dirty_orders_feed(spark, sf_dir), path)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = {}
    for key, stored in paths.items():
        write_stored_lines(spark, stored, f"{path}/text/{key}", files)
        read[key] = read_ordered_lines(spark, f"{path}/text/{key}", f"{path}/read/{key}")
    return ordering.keyed(read)


def _stream_three_orderings(spark, sf_dir):
    """Files of ``STREAM_FILE_ROWS`` rows, two per micro-batch; of more rows if there were over ``STREAM_FILES``."""
    path = scratch.new_path(spark, "stream-orderings")
    at_most = rows_per_file(tables.orders_rows(spark, sf_dir), STREAM_FILE_ROWS, STREAM_FILES)
    write_feed(tables.dirty_orders_feed(spark, sf_dir), f"{path}/feed", at_most)
    paths = job.order_stream(stream_feed(spark, f"{path}/feed", 2), path)
    return ordering.keyed({key: ordering.read_ordering(spark, p) for key, p in paths.items()})


def _incremental_orderings(spark, sf_dir):
    """Three drains of a feed that grows; each adds its batches to the stored orderings."""
    path = scratch.new_path(spark, "incremental")
    feed = tables.dirty_orders_feed(spark, sf_dir)
    for third in range(DRAINS):
        part = feed.filter(F.pmod(F.xxhash64("partition", "offset"), F.lit(DRAINS)) == third)
        part.write.mode("append").parquet(f"{path}/feed")
        paths = job.order_stream_by_batches(stream_feed(spark, f"{path}/feed"), path)
    return ordering.keyed({key: ordering.read_ordering(spark, p) for key, p in paths.items()})


def _write_slices(spark, sf_dir, path, number_of, held=None):
    """The events feed in the order of time, a file per slice; some rows ``held`` for later slices."""
    feed = tables.events_feed(spark, sf_dir)
    share = F.ntile(number_of).over(Window.orderBy("day")).alias("slice")
    day = F.date_trunc("day", "timestamp").alias("day")
    slices, _ = stored_rows(feed.select(day).distinct().select("day", share), "event-days")
    cut = feed.withColumn("day", day).join(slices, "day").drop("day")
    if held is not None:
        cut = cut.withColumn("slice", F.least(F.col("slice") + held, F.lit(number_of)))
    for number in range(1, number_of + 1):
        part = cut.filter(F.col("slice") == number).drop("slice")
        part.coalesce(1).write.mode("append").parquet(path)


def _idle_cut_stream(spark, sf_dir):
    """The events feed in the order of time, as four files, one per micro-batch."""
    path = scratch.new_path(spark, "idle-stream")
    _write_slices(spark, sf_dir, f"{path}/feed", SLICES)
    idle.drain_idle_cut(
        stream_feed(spark, f"{path}/feed", 1), f"{path}/out", f"{path}/offsets", HOUR_SECONDS, LATE_SECONDS
    )
    return drain.read_batches(spark, f"{path}/out/rows")


def _throughput_stream(spark, sf_dir):
    """The events feed in eight slices of time; every 50th row comes three slices later."""
    path = scratch.new_path(spark, "throughput-stream")
    held = F.when(F.col("offset") % HELD_EVERY == 0, HELD_SLICES).otherwise(0)
    _write_slices(spark, sf_dir, f"{path}/feed", RATE_SLICES, held)
    limits = (DAY_SECONDS, EVENTS_START, LATE_SECONDS)
    rates.drain_throughput(stream_feed(spark, f"{path}/feed", 1), f"{path}/out", f"{path}/offsets", *limits)
    return rates.read_throughput(spark, f"{path}/out", *limits)


def _drain_replayed(spark, sf_dir):
    """A feed of which every third row comes again later, drained with a restart between."""
    path = scratch.new_path(spark, "replayed")
    feed = tables.dirty_orders_feed(spark, sf_dir)
    for again in (False, True):
        part = feed.filter(F.col("offset") % 3 == 0) if again else feed
        part.write.mode("append").parquet(f"{path}/feed")
        replay.drain_distinct(stream_feed(spark, f"{path}/feed"), f"{path}/rows", f"{path}/offsets", "1 hour")
    return replay.read_distinct(spark, f"{path}/rows")


def _offset_gaps(spark, sf_dir):
    """Malformed rows are holes among the records; some records come twice."""
    records = _dirty(spark, sf_dir).select("partition", "offset")
    return offsets.offset_gaps(records.unionByName(records.filter(F.col("offset") % AGAIN_EVERY < 3)))


def _reconcile_diff(spark, sf_dir):
    path, faulty = _faulty_orderings(spark, sf_dir)
    produced = job.read_valid(spark, f"{path}/parsed")
    return differences.reconcile_diff(produced, ordering.keyed(faulty), SORT_KEYS)


def _publish_resumed(spark, sf_dir):
    """Orderings published as text in stretches, by two runs: the first one is stopped."""
    path = scratch.new_path(spark, "resumed")
    paths = job.order_feed(tables.dirty_orders_feed(spark, sf_dir), path)
    read = {}
    for key, stored in paths.items():
        target = f"{path}/text/{key}"
        resumed.publish_resumed(spark, stored, target, STRETCHES, 2, stop_before=2)
        resumed.publish_resumed(spark, stored, target, STRETCHES, 2)
        read[key] = resumed.read_published(spark, target)
    return ordering.keyed(read)


def _lines_to_orderings(spark, sf_dir):
    path = scratch.new_path(spark, "lines-feed")
    write_lines(tables.dirty_orders_feed(spark, sf_dir), f"{path}/text")
    return job.three_orderings(lines_feed(spark, f"{path}/text", f"{path}/feed"), f"{path}/orderings")


def _write_runs(spark, sf_dir):
    path = scratch.new_path(spark, "runs")
    write_runs(runs.sorted_runs(_dirty(spark, sf_dir), FLUSH), path)
    return spark.read.parquet(path).select("key", "partition", "run", "pos_in_run", "raw")


def _write_feed(spark, sf_dir):
    path = scratch.new_path(spark, "feed")
    write_feed(tables.orders_feed(spark, sf_dir), path)
    return scan_feed(spark, path)


QUERIES: dict[str, Query] = {
    "generate_feed": _generate_feed,
    "scan_feed": _scan_feed,
    "stream_drain": _stream_drain,
    "scan_lines": _scan_lines,
    "cap_per_partition": _cap_per_partition,
    "parse_feed": _parse_feed,
    "parse_documents": _parse_documents,
    "valid_records": _dirty,
    "rejects": _rejects,
    "sorted_by_id": _sorted_by("id"),
    "sorted_by_name": _sorted_by("name"),
    "sorted_by_continent": _sorted_by("continent"),
    "sorted_runs": _sorted_runs,
    "merge_runs": _merge_runs,
    "three_orderings": _three_orderings,
    "head_of_ordering": _head_of_ordering,
    "intake_stats": _intake_stats,
    "topic_size": _topic_size,
    "throughput": _throughput,
    "throughput_dirty": _throughput_dirty,
    "throughput_stream": _throughput_stream,
    "milestones": _milestones,
    "completion_summary": _completion_summary,
    "reconcile": _reconcile,
    "liveness": _liveness,
    "verify_sorted": _verify_sorted,
    "verify_head": _verify_head,
    "idle_cut": _idle_cut,
    "expected_count": _expected_count,
    "fixed_batches": _fixed_batches,
    "shard_quota": _shard_quota,
    "shard_quota_dirty": _shard_quota_dirty,
    "stream_sort": _stream_sort,
    "publish_ordering": _publish_ordering,
    "publish_lines": _publish_lines,
    "stream_three_orderings": _stream_three_orderings,
    "incremental_orderings": _incremental_orderings,
    "idle_cut_stream": _idle_cut_stream,
    "drain_replayed": _drain_replayed,
    "offset_gaps": _offset_gaps,
    "reconcile_diff": _reconcile_diff,
    "publish_resumed": _publish_resumed,
    "lines_to_orderings": _lines_to_orderings,
    "reconcile_faults": _reconcile_faults,
    "verify_faults": _verify_faults,
    "verify_head_faults": _verify_head_faults,
    "write_runs": _write_runs,
    "write_feed": _write_feed,
}


def _without_time_zone(query: Query) -> Query:
    """Show moments as the wall-clock times they have in the tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = query(spark, sf_dir)
        return result.select([
            F.col(field.name).cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(field.name)
            for field in result.schema
        ])

    return run


def all_queries() -> dict[str, Query]:
    return {name: _without_time_zone(query) for name, query in QUERIES.items()}
