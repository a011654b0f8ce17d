"""Results that are written once, and metrics that outlive a stream's own reports."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRICS = ("query_id string, batch_id long, name string, run_id string, reported string,"
           " input_rows long, late_rows long, state_rows long, state_bytes long,"
           " updated_rows long, batch_ms long")


def _replace(rows: DataFrame, path: str, *parts: str) -> None:
    """Write rows into folders by ``parts``, in place of what those folders held."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def once_writer(path: str, after: Callable[[int], None] | None = None):
    """A function for ``foreachBatch`` that appends a batch's rows to a Parquet table once.

    Rows are kept by stream and batch number.  A batch that is run again, because the stream
    ended between writing and its commit, puts the same rows in the place of the old ones;
    another stream, or one begun anew, has folders of its own.  ``after`` is called with the
    number when the rows are written.
    """
    def write(rows: DataFrame, batch: int) -> None:
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        numbered = rows.select(
            F.lit(stream).alias("stream_id"), F.lit(batch).cast("long").alias("batch_id"), "*")
        _replace(numbered, path, "stream_id", "batch_id")
        if after:
            after(batch)

    return write


def start_once_stream(messages: DataFrame, name: str, checkpoint: str, path: str,
                      available_now: bool = False,
                      after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Append messages to the table at ``path``, each once whatever fails and is run again."""
    writer = (
        messages.writeStream.queryName(name).outputMode("append")
        .foreachBatch(once_writer(path, after)).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def once_table(spark: SparkSession, path: str, messages: DataFrame) -> DataFrame:
    """The rows written so far, with the columns of ``messages``."""
    return spark.read.parquet(path).select(*(F.col(f"`{c}`") for c in messages.columns))


class MetricsTable(StreamingQueryListener):
    """Writes every batch's report to a table: input, late and state rows, state size, time.

    A stream keeps only its last reports; the table keeps all of them, over restarts too.  A
    report that comes again for a batch replaces the earlier one, so totals count a batch once.
    Idle reports are of the batch to come, and are replaced by it.  Add it with
    ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = event.progress
        states = report.stateOperators
        row = (
            str(report.id), report.batchId, report.name or "", str(report.runId), report.timestamp,
            report.numInputRows, sum(s.numRowsDroppedByWatermark for s in states),
            sum(s.numRowsTotal for s in states), sum(s.memoryUsedBytes for s in states),
            sum(s.numRowsUpdated for s in states), report.batchDuration)
        _replace(self.spark.createDataFrame([row], METRICS).coalesce(1), self.path,
                 "query_id", "batch_id")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout: float = 60) -> bool:
        """Whether all reports of a stream that has ended are written."""
        return self._end_of(str(query.runId)).wait(timeout)


def batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per stream and batch."""
    return spark.read.schema(METRICS).parquet(path)


def stream_totals(spark: SparkSession, path: str) -> DataFrame:
    """Per stream: batches, input and late rows over its whole life, state rows at last."""
    return batch_metrics(spark, path).groupBy("query_id", "name").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.max_by("state_rows", "batch_id").alias("state_rows"))
