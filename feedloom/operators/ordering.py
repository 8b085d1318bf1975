"""Total orders of records, stored once and read with explicit positions.

``store_ordering`` sorts with one range shuffle and stamps each row with its place:
the number of the sorted partition, ``bucket``, and the number of the row in it. The
place is written with the rows, so it can never disagree with a second evaluation of
the sort. A second small table counts the rows per piece, a stretch of a sorted partition;
joined to it, the place becomes the dense position 1..n without another shuffle or a
single-task window.

``extend_ordering`` adds a batch: only the pieces into which new records fall are written
again, as pieces of a new generation, and a new table of pieces gives all positions.

    path/rows/gen=G    the rows that generation G has written
    path/pieces/v=V    the pieces of version V, in order
    path/total         a row per finished version, written last

The last version in ``total`` is the ordering. Without one, it is not finished.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from feedloom import scratch
from feedloom.contract import HEAD_SIZE, SORT_KEYS, sort_columns
from feedloom.functions import lines
from feedloom.functions.numbers import floor_div
from feedloom.operators.ranges import deal, key_of, range_of
from feedloom.operators.sizing import ranges_for, stored_rows, table_options

# monotonically_increasing_id counts the rows of a partition in its 33 low bits.
ROW_MASK = (1 << 33) - 1

TOTAL = "version INT, n BIGINT, batch BIGINT"
# ``target`` is the piece of the version before in which new and old rows met; 0 at first.
PLACE = ("gen", "bucket", "target")
PIECES = "gen INT, bucket INT, target INT, n BIGINT, first_row BIGINT, piece INT, before BIGINT"
CONTENT = ("raw", "id", "name", "continent", "partition", "offset")


def in_order(records: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """Records sorted by ``key``; ``ranges`` fixes the number of sorted partitions."""
    columns = sort_columns(key)
    if ranges is None:
        return records.orderBy(*columns)
    return records.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)


def _lean(records: DataFrame, key: str) -> DataFrame:
    """What the sort needs and no more: the line has all the rest."""
    return records.select("raw", *sort_columns(key))


def _measured(records: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Lean records, made once, and the bytes of their lines."""
    size = F.coalesce(F.sum(F.octet_length("raw").cast("bigint")), F.lit(0))
    rows, seen = stored_rows(_lean(records, key), f"lean-{key}", {"bytes": size}, **table_options("raw", "offset"))
    return rows, seen["bytes"]


def store_ordering(
    records: DataFrame, key: str, path: str, ranges: int | None = None,
    bounds: list | None = None, batch: int = -1,
) -> None:
    """Write ``records`` in the order of ``key``, one file sequence per sorted partition.

    The number of ranges is measured if it isn't given. With ``bounds`` (rows of
    ``ranges.key_of``, in order) ranges are cut there and nothing is sampled.
    """
    sort_columns(key)
    rows = _lean(records, key)
    if bounds is not None:
        in_place = deal(rows, key, bounds)
    else:
        if ranges is None:
            rows, raw_bytes = _measured(records, key)
            ranges = ranges_for(raw_bytes)
        in_place = in_order(rows, key, ranges)
    for part in ("total", "pieces", "rows"):
        scratch.remove(records.sparkSession, f"{path}/{part}")
    _write_rows(in_place.withColumn("target", F.lit(0)), path, 0)
    _publish(records.sparkSession, path, _counted(records.sparkSession, path, 0), 0, batch)


def _write_rows(in_place: DataFrame, path: str, gen: int) -> None:
    place = {"bucket": F.spark_partition_id(), "row": F.monotonically_increasing_id().bitwiseAND(ROW_MASK)}
    (
        in_place.select(*[column.alias(name) for name, column in place.items()], "*")
        .write.mode("overwrite").options(**table_options("row", "raw", "offset")).parquet(f"{path}/rows/gen={gen}")
    )


def _counted(spark: SparkSession, path: str, gen: int) -> list[Row]:
    """The pieces of a generation. There are about as many as the sort had partitions.

    Only columns are read that are constant in most files. The pieces of one sorted
    partition follow each other in it by target.
    """
    rows = spark.read.schema("bucket INT, target INT").parquet(f"{path}/rows/gen={gen}")
    found, held = [], {}
    for p in sorted(rows.groupBy("bucket", "target").agg(F.count("*").alias("n")).collect()):
        start = held.get(p["bucket"], 0)
        held[p["bucket"]] = start + p["n"]
        found.append(Row(gen=gen, first_row=start, **p.asDict()))
    if max(held.values(), default=0) > ROW_MASK:
        raise ValueError("a sorted partition has too many rows to number; use more ranges")
    return sorted(found, key=lambda p: (p["target"], p["bucket"]))


def _publish(spark: SparkSession, path: str, pieces: list[Row], version: int, batch: int) -> None:
    """Make these pieces, in this order, the ordering."""
    rows, before = [], 0
    for i, p in enumerate(pieces):
        rows.append((p["gen"], p["bucket"], p["target"], p["n"], p["first_row"], i, before))
        before += p["n"]
    _write_pieces(spark.createDataFrame(rows, PIECES), f"{path}/pieces/v={version}")
    total_row = spark.createDataFrame([(version, before, batch)], TOTAL)
    total_row.coalesce(1).write.mode("append").parquet(f"{path}/total")


def _write_pieces(pieces: DataFrame, path: str) -> None:
    pieces.coalesce(1).write.mode("overwrite").parquet(path)


def _current(spark: SparkSession, path: str) -> Row:
    """version, n and batch of a stored ordering; an error if it is not finished."""
    known = None
    if scratch.exists(spark, f"{path}/total"):
        known = spark.read.schema(TOTAL).parquet(f"{path}/total").collect()
    if not known:
        raise RuntimeError(f"the ordering in {path} is not finished")
    return max(known, key=lambda row: row["version"])


def total(spark: SparkSession, path: str) -> int:
    """The rows of a stored ordering; an error if it is not finished."""
    return _current(spark, path)["n"]


def read_ordering(spark: SparkSession, path: str) -> DataFrame:
    """A stored ordering with ``pos``, and ``bucket``: the piece it lies in.

    The table of pieces has about as many rows as the sort had partitions. Catalyst knows
    its file size and broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return _with_pos(_read_rows(spark, path), _read_pieces(spark, path))


def in_stretches(spark: SparkSession, path: str, n: int) -> DataFrame:
    """A stored ordering dealt to ``n`` tasks: the i-th has the i-th stretch of positions.

    Positions are dense, so the stretches are of like length. Rows go straight to their
    task by position; no key is compared or sampled again.
    """
    rows = max(total(spark, path), 1)
    stretch = floor_div((F.col("pos") - 1) * n, rows).cast("int")
    return read_ordering(spark, path).repartitionById(n, stretch).sortWithinPartitions("pos")


def version_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """The version of a stored ordering and its rows; both grow with every batch."""
    now = _current(spark, path)
    return now["version"], now["n"]


def read_stretch(spark: SparkSession, path: str, first: int, last: int, tasks: int) -> DataFrame:
    """The rows from position ``first`` to ``last`` in order, dealt to ``tasks`` tasks.

    Only the pieces that reach into the stretch are read.
    """
    pieces = _read_pieces(spark, path).filter((F.col("before") < last) & (F.col("before") + F.col("n") >= first))
    held = pieces.select("gen", "bucket").distinct().collect()
    near = F.col("gen").isin([p["gen"] for p in held]) & F.col("bucket").isin([p["bucket"] for p in held])
    rows = _with_pos(_read_rows(spark, path).filter(near), pieces).filter(F.col("pos").between(first, last))
    part = floor_div((F.col("pos") - first) * tasks, max(last - first + 1, 1)).cast("int")
    return rows.drop("bucket").repartitionById(tasks, part).sortWithinPartitions("pos")


def read_head(spark: SparkSession, path: str, n: int = HEAD_SIZE) -> DataFrame:
    """The first ``n`` rows of a stored ordering.

    The table of pieces tells where they lie, at most ``n`` pieces, and the scan skips all
    row groups beyond.
    """
    pieces = _read_pieces(spark, path)
    holders = pieces.filter(F.col("before") < n).collect()
    in_head = F.lit(False)
    for p in holders:
        at = reduce(lambda a, b: a & b, [F.col(c) == p[c] for c in PLACE])
        in_head |= at & (F.col("row") < p["first_row"] + n - p["before"])
    return _with_pos(_read_rows(spark, path).filter(in_head), pieces).drop("bucket")


def _read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Stored rows; fields that were not sort columns are cut from the line again."""
    rows = spark.read.parquet(f"{path}/rows")
    line = F.col("raw")
    missing = {"name": lines.name_of(line), "continent": lines.continent_of(line)}
    return rows.withColumns({c: made for c, made in missing.items() if c not in rows.columns})


def _read_pieces(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    version = _current(spark, path)["version"] if version is None else version
    return spark.read.schema(PIECES).parquet(f"{path}/pieces/v={version}")


def _with_pos(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Rows of live pieces; those of pieces that were written again have no partner."""
    known = pieces.select(*PLACE, "first_row", "piece", "before")
    pos = (F.col("before") + F.col("row") - F.col("first_row") + 1).cast("bigint")
    return rows.join(known, list(PLACE)).select(pos.alias("pos"), *CONTENT, F.col("piece").alias("bucket"))


def _piece_starts(spark: SparkSession, path: str, key: str, pieces: DataFrame) -> list[Row]:
    """The key of the first row of each piece, in order. Scans skip all but first rows' pages."""
    first = spark.read.parquet(f"{path}/rows").join(pieces.select(*PLACE, "first_row", "piece"), list(PLACE))
    starts = first.filter(F.col("row") == F.col("first_row")).select("piece", key_of(key).alias("k")).collect()
    return [row["k"] for row in sorted(starts, key=lambda row: row["piece"])]


def extend_ordering(records: DataFrame, key: str, path: str, batch: int | None = None) -> None:
    """Add ``records`` to a stored ordering, or store the first ones.

    A record falls into the piece with the last start that isn't above it. The pieces that
    get records are sorted anew together with them, cut into ranges by their bytes; all
    other pieces keep their files. Pieces never mix, so the order between them holds. With
    ``batch``, a number that grows, a batch that was added already changes nothing.
    """
    spark = records.sparkSession
    sort_columns(key)
    if not scratch.exists(spark, f"{path}/total"):
        store_ordering(records, key, path, batch=-1 if batch is None else batch)
        return
    now = _current(spark, path)
    if batch is not None and batch <= now["batch"]:
        return
    seen = now["batch"] if batch is None else batch
    rows, raw_bytes = _measured(records, key)
    pieces = _read_pieces(spark, path, now["version"])
    listed = sorted(pieces.collect(), key=lambda p: p["piece"])
    gen = 1 + max((p["gen"] for p in listed), default=0)
    starts = _piece_starts(spark, path, key, pieces)
    # What is below the first start goes to the first piece.
    target = F.greatest(range_of(key, starts) - 1, F.lit(0))
    new = rows.withColumn("target", target)
    fresh = {row["target"]: row["count"] for row in new.groupBy("target").count().collect()}
    if not fresh:
        return
    touched = [p for p in listed if p["piece"] in fresh]
    old = spark.read.parquet(f"{path}/rows").join(
        F.broadcast(spark.createDataFrame(  # at most a row per piece
            [(p["gen"], p["bucket"], p["target"], p["piece"]) for p in touched],
            "gen INT, bucket INT, target INT, piece INT",
        )), list(PLACE),
    ).select("raw", *sort_columns(key), F.col("piece").alias("target"))
    moved = sum(p["n"] for p in touched)
    ranges = ranges_for(raw_bytes * (1 + moved // max(sum(fresh.values()), 1)))
    order = ["target", *sort_columns(key)]
    together = new.unionByName(old) if touched else new
    _write_rows(together.repartitionByRange(ranges, *order).sortWithinPartitions(*order), path, gen)
    made: dict[int, list[Row]] = {}
    for p in _counted(spark, path, gen):
        made.setdefault(p["target"], []).append(p)
    after = [q for p in listed for q in made.get(p["piece"], [p])] if listed else [q for ps in made.values() for q in ps]
    _publish(spark, path, after, now["version"] + 1, seen)


def sweep(spark: SparkSession, path: str) -> int:
    """Remove files that only hold rows of pieces written again since; returns how many.

    Nobody may read an older version meanwhile.
    """
    rows = spark.read.parquet(f"{path}/rows").select(*PLACE, F.col("_metadata.file_path").alias("file"))
    files = rows.distinct().join(
        _read_pieces(spark, path).select(*PLACE, F.lit(True).alias("live")), list(PLACE), "left"
    ).groupBy("file").agg(F.max("live").alias("live"))
    dead = [row["file"] for row in files.filter("live is null").select("file").collect()]
    for file in dead:
        scratch.remove(spark, file)
    return len(dead)


def sorted_by(records: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """Records with their position in the order of ``key``; the sort is sized by their bytes."""
    sort_columns(key)
    path = scratch.new_path(records.sparkSession, f"ordering-{key}")
    store_ordering(records, key, path, ranges)
    return read_ordering(records.sparkSession, path).drop("bucket")


def head_of_ordering(records: DataFrame, key: str, n: int = HEAD_SIZE) -> DataFrame:
    """The first ``n`` records of an ordering, by a top-n instead of a full sort."""
    columns = sort_columns(key)
    top = records.orderBy(*columns).limit(n)
    pos = F.row_number().over(Window.orderBy(*columns)).cast("bigint")
    return top.select(pos.alias("pos"), *CONTENT)


def merge_runs(runs: list[DataFrame]) -> DataFrame:
    """All rows of all runs, ready to be ordered; equal rows are all kept.

    A run set may hold any number of runs in any order: the sort that follows is
    a merge of runs of its own and relies on none of the given ones.
    """
    if not runs:
        raise ValueError("no runs to merge")
    return reduce(lambda left, right: left.unionByName(right), runs)


def for_each_key(action: Callable[[str], None], keys: Iterable[str], at_once: int = len(SORT_KEYS)) -> None:
    """Run ``action`` for every key, some at a time; a failure fails the call."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for done in [pool.submit(action, key) for key in keys]:
            done.result()


def keyed(orderings: dict[str, DataFrame]) -> DataFrame:
    """Several orderings in one table ``key, pos, raw``."""
    return reduce(
        lambda left, right: left.unionByName(right),
        [o.select(F.lit(key).alias("key"), "pos", "raw") for key, o in orderings.items()],
    )
