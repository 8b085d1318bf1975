"""Exact duplicates by an extendible-hash index on shared files.

The index has a directory (one slot for each value of the first ``depth`` bits of a
64-bit hash, pointing to a bucket) and buckets of entries. Building starts with one
slot; a bucket with more bytes than it may hold is split by its next bit, and the
directory doubles when a bucket needs more bits than it has. Each bucket has one owner
task, which chains the different texts that share a hash and compares them byte by byte.

Copies of one text never travel together: every Arrow batch sends a text once, with the
count of its copies, so an owner gets at most one row for a text and batch.

Defined cases: a null text equals an empty one; a null doc_id is smaller than any other;
of rows with equal text and equal doc_id all count and all are marked kept or not
alike, except that in ``survivors`` one row stays; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import stored, text_of

#: Bytes of different texts that a bucket may hold before it is split.
BUCKET_BYTES = 32 << 20
#: A directory can use so many bits of a hash; hashes that differ in none of them are chained.
HASH_BITS = 63


def _slot(depth: int):
    """The first bits of a hash; depth 0 has one slot."""
    return F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")


def build_directory(sizes: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, DataFrame]:
    """The depth, and a table: slot, bucket (the first slot of its bucket), bytes.

    ``sizes``: h, bytes; one row per hash. The directory doubles until no bucket is
    overfull, but for those of a single hash, which no bit can split. A bucket that needs
    fewer bits than the directory has keeps several slots. Slots without a hash have no
    row; only the bytes of the fullest slot come to the driver.
    """
    depth = 0
    while True:
        slots = sizes.groupBy(_slot(depth).alias("slot")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")
        )
        most = slots.where("n > 1").agg(F.max("bytes")).first()[0] or 0
        if most <= bucket_bytes or depth == HASH_BITS:
            break
        # Halving happens a bit at a time; count again only where the next doublings lead.
        depth = min(HASH_BITS, depth + max(1, (most // bucket_bytes).bit_length()))

    # A bucket has the fewest first bits with which it is not overfull.
    slots = stored(slots, "dedup-slots")
    prefixes = slots.withColumn("bits", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumn(
        "first", F.expr(f"shiftleft(shiftrightunsigned(slot, {depth} - bits), {depth} - bits)")
    )
    fitting = prefixes.groupBy("bits", "first").agg(F.sum("bytes").alias("all"), F.sum("n").alias("hashes")).where(
        (F.col("all") <= bucket_bytes) | (F.col("hashes") == 1) | (F.col("bits") == depth)
    )
    buckets = prefixes.join(fitting.select("bits", "first"), ["bits", "first"]).groupBy("slot").agg(
        F.min_by("first", "bits").alias("bucket"), F.first("bytes").alias("bytes")
    )
    return depth, stored(buckets, "dedup-directory")


_ENTRY = pa.schema([("h", pa.int64()), ("text", pa.string()), ("last", pa.int64()), ("copies", pa.int64())])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a batch once, with its largest doc_id and its number of rows."""
    for batch in batches:
        held = pa.Table.from_batches([batch]).group_by(["h", "text"]).aggregate(
            [("doc_id", "max"), ("doc_id", "count", pc.CountOptions(mode="all"))]
        )
        yield from held.rename_columns(
            ["h", "text", "last", "copies"]
        ).cast(_ENTRY).to_batches()


def build_index(docs: DataFrame, keys: DataFrame, **limits: int) -> DataFrame:
    """The entries of the index on shared files.

    ``docs``: doc_id, text, h. ``keys``: h, bytes of every row. Returns bucket, h, chain
    (how many different texts have the hash), keep_id, group_size, and the text only
    where a hash has more than one.
    """
    spark = docs.sparkSession
    sizes = keys.groupBy("h").agg(F.max("bytes").alias("bytes"))
    depth, directory = build_directory(sizes, **limits)
    sent = docs.select("h", "text", "doc_id").mapInArrow(
        _combine, "h long, text string, last long, copies long"
    )
    # An owner has several buckets where these are many: tasks grow with the root of the bytes.
    held = directory.agg(F.countDistinct("bucket"), F.sum("bytes")).first()
    roots = int(4 * ((held[1] or 0) / (1 << 20)) ** 0.5)
    width = max(min(held[0], roots), int(spark.conf.get("spark.sql.shuffle.partitions")))
    owned = (
        sent.withColumn("slot", _slot(depth))
        .join(directory.select("slot", "bucket"), "slot")  # broadcast only while its files are small
        .repartition(width, "bucket")
        .groupBy("bucket", "h", "text")  # the bytes are compared here, in the owner
        .agg(F.max("last").alias("keep_id"), F.sum("copies").alias("group_size"))
        .withColumn("chain", F.count(F.lit(1)).over(Window.partitionBy("bucket", "h")))
        .withColumn("text", F.when(F.col("chain") > 1, F.col("text")))
    )
    return stored(owned, "dedup-index")


def exact_duplicates(docs: DataFrame, hashed=F.xxhash64, **limits: int) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``.

    ``hashed`` makes the 64-bit hash of a text; the result doesn't depend on it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("h", hashed("text"))
    keys = stored(
        rows.select(
            "doc_id", "h",
            F.octet_length("text").cast("long").alias("bytes"),
            F.unhex(F.sha2("text", 256)).alias("sha"),
        ),
        "dedup-keys",
    )
    index = build_index(rows, keys, **limits)
    found = ["doc_id", "sha", "keep_id", "group_size"]
    single = index.where("chain = 1").select("h", "keep_id", "group_size")
    settled = keys.join(single, "h").select(*found)
    # Hashes that several texts share are told apart by their bytes.
    several = index.where("chain > 1").select("h", "text", "keep_id", "group_size")
    clashed = (
        rows.join(several, ["h", "text"])
        .withColumn("sha", F.unhex(F.sha2("text", 256)))
        .select(*found)
    )
    if several.isEmpty():
        clashed = settled.limit(0)
    return settled.unionByName(clashed).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def survivors(docs: DataFrame) -> DataFrame:
    """One row for each text, all columns of ``docs``: that with the largest doc_id."""
    kept = (
        exact_duplicates(docs)
        .where("kept")
        .select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).alias("_key"))
        .distinct()
    )
    key = F.struct(
        F.col("doc_id").cast("long").alias("id"), F.sha2(text_of(), 256).alias("sha")
    )
    rows = docs.select(F.struct("*").alias("_row"), F.to_json(key).alias("_key"))
    return (
        rows.join(kept.select(F.to_json("_key").alias("_key")), "_key")
        .dropDuplicates(["_key"])  # rows that repeat the doc_id, too
        .select("_row.*")
    )
