"""Synthetic records: one per id, the same whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.contract import ADDRESS_CHARACTERS, CONTINENTS, LETTERS
from feedloom.functions.lines import format_line

# Field lengths.
NAME_LENGTHS = (10, 15)
ADDRESS_LENGTHS = (15, 20)

# Of the 43 base64 digits of a digest the last one holds less than 6 bits.
WHOLE_DIGITS = 42


def _digest(seed: int, salt: str) -> Column:
    """256 random-looking bits, as hex, from nothing but the id, the seed and the salt."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"), F.lit(salt)), 256)


def _base64(digest: Column) -> Column:
    return F.substring(F.base64(F.unhex(digest)), 1, WHOLE_DIGITS)


def _name_characters(digest: Column) -> Column:
    """Letters drawn by rejection: base64 digits that are not letters are left out.

    Some 34 are left. Should they ever be too few, the alphabet itself follows.
    """
    return F.concat(F.regexp_replace(_base64(digest), "[0-9+/]", ""), F.lit(LETTERS))


def _address_characters(digest: Column) -> Column:
    """Likewise for 63 characters: a plus stands for the blank, a slash is left out."""
    spaced = F.replace(_base64(digest), F.lit("+"), F.lit(" "))
    return F.concat(F.replace(spaced, F.lit("/"), F.lit("")), F.lit(ADDRESS_CHARACTERS))


def _draw(number: Column, nth: int, choices: int) -> Column:
    return F.pmod(F.call_function("div", number, F.lit(nth)), F.lit(choices)).cast("int")


def records_for(ids: DataFrame, seed: int = 0) -> DataFrame:
    """Records ``id, name, address, continent, value`` for a table with ``id``."""
    names, addresses = (high - low + 1 for low, high in (NAME_LENGTHS, ADDRESS_LENGTHS))
    drawn = ids.select("id", _digest(seed, "n").alias("n"), _digest(seed, "a").alias("a"))
    # The end of the second digest, none of which goes into the address.
    drawn = drawn.withColumn("s", F.conv(F.substring("a", 50, 15), 16, 10).cast("bigint"))
    name, address = _name_characters(F.col("n")), _address_characters(F.col("a"))
    fields = drawn.select(
        "id",
        F.substring(name, F.lit(1), _draw(F.col("s"), 1, names) + NAME_LENGTHS[0]).alias("name"),
        F.substring(address, F.lit(1), _draw(F.col("s"), names, addresses) + ADDRESS_LENGTHS[0])
        .alias("address"),
        F.get(
            F.array(*[F.lit(continent) for continent in CONTINENTS]),
            _draw(F.col("s"), names * addresses, len(CONTINENTS)),
        ).alias("continent"),
    )
    columns = [F.col(column) for column in ("id", "name", "address", "continent")]
    return fields.withColumn("value", format_line(*columns))


def generate_feed(
    spark: SparkSession, n: int, seed: int = 0, topic_partitions: int = 4, tasks: int | None = None
) -> DataFrame:
    """``n`` records with ids 1..n as a feed, dealt out to the partitions in turn."""
    ids = spark.range(1, n + 1, 1, tasks)
    before = F.col("id") - 1
    return records_for(ids, seed).select(
        "value",
        F.pmod(before, F.lit(topic_partitions)).cast("int").alias("partition"),
        F.call_function("div", before, F.lit(topic_partitions)).alias("offset"),
        F.timestamp_micros(before).alias("timestamp"),
    )
