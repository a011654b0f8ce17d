"""Publishing records and messages (needs Spark's Kafka connector)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lanewatch.places import RESULTS_TOPIC


def kafka_sink_options(servers: str, topic: str | None = RESULTS_TOPIC) -> dict[str, str]:
    """Sink options; leave the topic out when the rows have a topic column."""
    options = {"kafka.bootstrap.servers": servers}
    return options | {"topic": topic} if topic else options


def publish_records(records: DataFrame, servers: str) -> None:
    """Write (key, value, topic) rows to their topics, as one batch job."""
    records.write.format("kafka").options(**kafka_sink_options(servers, None)).save()
