"""Feeds and orderings to Kafka topics; needs Spark's Kafka connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.ordering import in_order, in_stretches

FEED_OPTIONS = {"kafka.acks": "1", "kafka.compression.type": "snappy"}
ORDERING_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "snappy", "kafka.linger.ms": "50"}


def ordered_messages(records: DataFrame, key: str, topic_partitions: int) -> DataFrame:
    """``partition, value`` where topic partition i holds the i-th range in order.

    One task writes one topic partition: two tasks writing to the same one would
    mix their messages. With one partition per topic that is a sort in one task;
    give the topic enough partitions for its size and read them in turn.
    """
    return in_order(records, key, topic_partitions).select(
        F.spark_partition_id().alias("partition"), F.col("raw").alias("value")
    )


def stored_messages(spark: SparkSession, stored: str, topic_partitions: int) -> DataFrame:
    """The same from a stored ordering, which is not sorted by its key again."""
    return in_stretches(spark, stored, topic_partitions).select(
        F.spark_partition_id().alias("partition"), F.col("raw").alias("value")
    )


def publish_topic(
    spark: SparkSession, stored: str, servers: str, topic: str, topic_partitions: int
) -> None:
    """A task that runs again writes its messages again; ``job.check_published`` sees that."""
    stored_messages(spark, stored, topic_partitions).write.format("kafka").options(
        **ORDERING_OPTIONS
    ).option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_topic(feed: DataFrame, servers: str, topic: str) -> None:
    feed.select("value", "partition").write.format("kafka").options(**FEED_OPTIONS).option(
        "kafka.bootstrap.servers", servers
    ).option("topic", topic).save()
