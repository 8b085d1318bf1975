"""Generate a feed, order a feed, prove the result. For ``spark-submit``.

    spark-submit main.py --generate 50000000 --out /shared/run1
    spark-submit main.py --feed /shared/feed --out /shared/run2 --idle-seconds 60
    spark-submit main.py --lines /shared/text --out /shared/run3 --text-files 64
    spark-submit main.py --feed /shared/feed --stream --out /shared/run4
    spark-submit main.py --servers host:9092 --topic source --out /shared/run5 \\
        --publish-partitions 64
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedloom import scratch
from feedloom.contract import SORT_KEYS
from feedloom.operators.ordering import read_head
from feedloom.plans import job
from feedloom.sinks.files import write_feed, write_stored_lines
from feedloom.sinks.kafka import publish_topic
from feedloom.sources.files import lines_feed, scan_feed, stream_feed
from feedloom.sources.kafka import scan_topic, stream_topic
from feedloom.sources.synthetic import generate_feed


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--generate", type=int, metavar="N", help="make N records first")
    source.add_argument("--feed", help="a feed stored as parquet")
    source.add_argument("--lines", help="a folder of text, a record in each line")
    source.add_argument("--topic", help="a Kafka topic; needs --servers")
    parser.add_argument("--servers", help="Kafka servers to read from and publish to")
    parser.add_argument("--out", required=True, help="folder for all results")
    parser.add_argument("--keys", nargs="+", default=list(SORT_KEYS), choices=SORT_KEYS)
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--max-records", type=int, default=0, help="per partition; 0: all")
    parser.add_argument("--idle-seconds", type=int, help="stop a partition at such a silence")
    parser.add_argument("--stream", action="store_true", help="drain --feed or --topic as a stream")
    parser.add_argument("--text-files", type=int, help="write orderings as so many texts each")
    parser.add_argument("--publish-partitions", type=int, help="publish to topics of that width")
    chosen = parser.parse_args(argv)
    if (chosen.topic or chosen.publish_partitions) and not chosen.servers:
        parser.error("--topic and --publish-partitions need --servers")
    if chosen.stream and not (chosen.feed or chosen.topic):
        parser.error("--stream needs --feed or --topic")
    return chosen


def run(spark: SparkSession, chosen: argparse.Namespace) -> None:
    keys, limits = tuple(chosen.keys), (chosen.max_records, chosen.idle_seconds)
    if chosen.topic:
        scan = stream_topic if chosen.stream else scan_topic
        feed = scan(spark, chosen.servers, chosen.topic)
    elif chosen.feed:
        feed = (stream_feed if chosen.stream else scan_feed)(spark, chosen.feed)
    elif chosen.lines:
        feed = lines_feed(spark, chosen.lines, f"{chosen.out}/feed")
    else:
        write_feed(generate_feed(spark, chosen.generate, chosen.seed), f"{chosen.out}/feed")
        feed = scan_feed(spark, f"{chosen.out}/feed")
    order = job.order_stream if chosen.stream else job.order_feed
    paths = order(feed, chosen.out, keys, *limits)
    reports = job.report(spark, chosen.out, keys, *limits)
    for name, table in reports.items():
        print(name)
        table.write.mode("overwrite").parquet(f"{chosen.out}/report/{name}")
        table.show(truncate=False)
    job.check(reports)
    for key, path in paths.items():
        print(f"first records by {key}")
        read_head(spark, path).orderBy("pos").show(truncate=False)
    records = job.bounded(job.read_valid(spark, f"{chosen.out}/parsed"), *limits)
    if chosen.text_files:
        came = {}
        for key, path in paths.items():
            write_stored_lines(spark, path, f"{chosen.out}/text/{key}", chosen.text_files)
            came[key] = spark.read.option("lineSep", "\n").text(f"{chosen.out}/text/{key}").toDF("raw")
        job.check_published(records, came)
    if chosen.publish_partitions:
        came = {}
        for key, path in paths.items():
            publish_topic(spark, path, chosen.servers, key, chosen.publish_partitions)
            came[key] = scan_topic(spark, chosen.servers, key).select(F.col("value").alias("raw"))
        job.check_published(records, came)


if __name__ == "__main__":
    session = SparkSession.builder.appName("feedloom").getOrCreate()
    try:
        run(session, arguments())
    finally:
        scratch.release(session)
