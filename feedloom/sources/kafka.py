"""Feeds in Kafka topics.

Needs Spark's Kafka connector on the class path. Store a topic before ordering it
(``feedloom.plans.job`` does): a plan that scans the topic twice may otherwise see
two different ends of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.sources.files import as_feed


def batch_options(servers: str, topic: str) -> dict[str, str]:
    """All partitions, from the first message to the last one there is now."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }


def stream_options(servers: str, topic: str, offsets_per_batch: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if offsets_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(offsets_per_batch)
    return options


def scan_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return as_feed(spark.read.format("kafka").options(**batch_options(servers, topic)).load())


def stream_topic(
    spark: SparkSession, servers: str, topic: str, offsets_per_batch: int | None = None
) -> DataFrame:
    options = stream_options(servers, topic, offsets_per_batch)
    return as_feed(spark.readStream.format("kafka").options(**options).load())
