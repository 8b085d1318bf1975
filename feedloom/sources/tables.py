"""Feeds made from the given tables; the joins only put the lines together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.contract import CONTINENTS
from feedloom.functions.lines import format_line
from feedloom.operators.intake import PLACE
from feedloom.sources.files import as_feed

# The columns used. Naming them saves a job per table that would look them up.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _orders_with_names(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    places = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = _table(spark, sf_dir, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return orders.join(
        people.select("c_custkey", "c_name", "r_name"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.col("o_orderkey").alias("k"),
        "c_name",
        "o_orderpriority",
        "r_name",
        F.pmod("o_orderkey", F.lit(4)).alias("partition"),
        F.call_function("div", F.col("o_orderkey"), F.lit(4)).alias("offset"),
        F.col("o_orderdate").alias("timestamp"),
    )


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One well-formed line per order: names repeat, five regions stand for continents."""
    rows = _orders_with_names(spark, sf_dir, _table(spark, sf_dir, "orders"))
    line = format_line(*[F.col(c) for c in ("k", "c_name", "o_orderpriority", "r_name")])
    return as_feed(rows.withColumn("value", line))


def orders_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the orders table, from the files' footers. As many lines has the feed of it,
    but for orders whose customer is missing or comes more than once."""
    return _table(spark, sf_dir, "orders").count()


def _damaged(rows: DataFrame) -> DataFrame:
    """Every kind of damage in fixed shares, plus odd lines that are still valid.

    By order key modulo 50: 0 other separators, 1 and 2 missing fields, 3 and 5 a
    bad id, 4 a comma in the last field, 6 an id with a sign. The line goes through
    a generator: a stored feed has it ready, and so no filter on it may be turned
    into many copies of the expression that makes it.
    """
    kind = F.pmod("k", F.lit(50))
    before = F.when(kind == 3, "x").when(kind == 5, " ").when(kind == 6, "+").otherwise("")
    comma = F.when(kind == 0, ";").otherwise(",")
    after = (
        F.when(kind == 1, "")
        .when(kind == 2, ",a")
        .otherwise(
            F.concat(
                comma, "o_orderpriority", comma, "r_name",
                F.when(kind == 4, ",tail").otherwise(""),
            )
        )
    )
    line = F.concat(before, F.col("k").cast("string"), comma, "c_name", after)
    return as_feed(rows.select(F.explode(F.array(line)).alias("value"), *PLACE))


def dirty_orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged(_orders_with_names(spark, sf_dir, _table(spark, sf_dir, "orders")))


def dirty_orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty orders feed read as a stream of the orders table."""
    orders = (
        spark.readStream.schema(SCHEMAS["orders"])
        .option("pathGlobFilter", "orders.parquet")
        .parquet(sf_dir)
    )
    return _damaged(_orders_with_names(spark, sf_dir, orders))


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event, by user into four partitions, in order of time."""
    events = _table(spark, sf_dir, "events")
    continent = F.get(
        F.array(*[F.lit(c) for c in CONTINENTS]),
        F.pmod("user_id", F.lit(len(CONTINENTS))).cast("int"),
    )
    return as_feed(events.select(
        format_line(F.col("event_id"), F.col("event_type"), F.col("props"), continent).alias("value"),
        F.pmod("user_id", F.lit(4)).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    ))


def documents_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per document; the last field is its whole text, commas, newlines and all."""
    documents = _table(spark, sf_dir, "documents")
    return as_feed(documents.select(
        format_line(*[F.col(c) for c in ("doc_id", "lang", "source", "text")]).alias("value"),
        F.pmod("doc_id", F.lit(4)).alias("partition"),
        F.call_function("div", F.col("doc_id"), F.lit(4)).alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    ))
