"""Event and result topics.

The Kafka readers need Spark's Kafka connector on the class path.  Every
reader gives the same columns: key, value, topic, timestamp.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lanewatch.plans.messages import parse_messages
from lanewatch.places import RESULTS_TOPIC
from lanewatch.schemas import STREAM_RECORD


def decode_bytes(raw: DataFrame) -> DataFrame:
    """Key and value bytes as UTF-8 text; null stays null."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "timestamp",
    )


def kafka_options(
    servers: str, topics: Iterable[str], starting_offsets: str = "earliest", **more: str
) -> dict[str, str]:
    """Source options: the subscribed topics and where a first start begins."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        **more,
    }


def kafka_stream(
    spark: SparkSession, servers: str, topics: Iterable[str],
    starting_offsets: str = "earliest", **more: str,
) -> DataFrame:
    options = kafka_options(servers, topics, starting_offsets, **more)
    return decode_bytes(spark.readStream.format("kafka").options(**options).load())


def kafka_results(spark: SparkSession, servers: str, topic: str = RESULTS_TOPIC) -> DataFrame:
    """The results topic from its start to its present end, as result rows."""
    options = kafka_options(servers, [topic], "earliest", endingOffsets="latest")
    return parse_messages(decode_bytes(spark.read.format("kafka").options(**options).load()))


def record_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A stream of record files (Parquet), in order of arrival.

    Bound the files per batch with ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger``.
    """
    return spark.readStream.schema(STREAM_RECORD).options(**options).parquet(path)


def result_table(spark: SparkSession, path: str) -> DataFrame:
    """Results from a table of messages (key, value) that a stream has written."""
    messages = spark.read.schema("key string, value string").parquet(path)
    return parse_messages(messages)
