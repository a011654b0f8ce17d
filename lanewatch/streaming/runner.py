"""Starting the analyses as streams, one query per analysis."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lanewatch.plans.analyses import active_analyses, analyse_records
from lanewatch.plans.messages import result_messages
from lanewatch.session import shared_root
from lanewatch.streaming.windows import WindowSpec


def checkpoint_path(spark: SparkSession, job: str, part: str) -> str:
    """A fixed path per job and analysis, so that a restart resumes."""
    return f"{shared_root(spark)}/{job}/{part}"


def start_stream(
    messages: DataFrame,
    name: str,
    checkpoint: str,
    sink_format: str,
    sink_options: dict[str, str],
    available_now: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append messages to a sink; a window is written once, when it is closed.

    ``state_partitions`` is the number of state partitions of a first start; a
    restart keeps what its checkpoint says.  The stream takes a copy of the
    session's settings, so other queries are not affected.
    """
    writer = (
        messages.writeStream.queryName(name).outputMode("append")
        .format(sink_format).options(**sink_options)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    if state_partitions is None:
        return writer.start()
    conf = messages.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return writer.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def start_analyses(
    spark: SparkSession,
    read_topic: Callable[[str], DataFrame],
    names: Iterable[str],
    job: str,
    sink_format: str,
    sink_options: Callable[[str], dict[str, str]],
    spec: WindowSpec = WindowSpec(),
    topics: dict[str, str] | None = None,
    available_now: bool = False,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """One stream per analysis, each reading only its own topic.

    ``read_topic(topic)`` gives the record stream and ``sink_options(name)``
    the sink's options.  Settings are checked before the first stream starts.
    """
    spec.column()
    started = []
    for name, (analysis, topic) in active_analyses(names, topics).items():
        messages = result_messages(analysis(read_topic(topic), topic, spec), name)
        started.append(start_stream(
            messages, name, checkpoint_path(spark, job, name),
            sink_format, sink_options(name), available_now, state_partitions,
        ))
    return started


def start_union(
    spark: SparkSession,
    records: DataFrame,
    names: Iterable[str],
    job: str,
    sink_format: str,
    sink_options: dict[str, str],
    spec: WindowSpec = WindowSpec(),
    topics: dict[str, str] | None = None,
    available_now: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """All analyses in one stream with one sink."""
    messages = analyse_records(records, names, spec, topics)
    return start_stream(
        messages, job, checkpoint_path(spark, job, "union"),
        sink_format, sink_options, available_now, state_partitions,
    )


def wait_for_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Block until one of the session's streams ends."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as too late, over the progress reports still kept."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
