"""Results written once, and metrics that last."""

import uuid

import pytest
from pyspark.errors import StreamingQueryException

from lanewatch.plans.analyses import traffic
from lanewatch.plans.events import positions_from_records
from lanewatch.places import FCD_TOPIC
from lanewatch.plans.messages import result_messages
from lanewatch.sources.topics import record_files
from lanewatch.streaming.durable import (
    MetricsTable, batch_metrics, once_table, start_once_stream, stream_totals,
)
from lanewatch.streaming.runner import checkpoint_path, late_rows
from lanewatch.streaming.windows import WindowSpec
from test_streams import FILES, record_file


@pytest.fixture
def job():
    return f"lanewatch-tests/{uuid.uuid4().hex}"


def messages(spark, source):
    records = record_files(spark, source, maxFilesPerTrigger="1")
    return result_messages(traffic(positions_from_records(records, FCD_TOPIC), WindowSpec()), "traffic")


@pytest.mark.parametrize("fails_at", [0, 2, 3])
def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path, job, fails_at):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in FILES:
        record_file(spark, source, rows)
    stream = messages(spark, source)
    path = checkpoint_path(spark, job, "traffic")
    seen = []

    def fail_once(batch):
        seen.append(batch)
        if batch == fails_at and seen.count(batch) == 1:
            raise RuntimeError("ended between write and commit")

    with pytest.raises(StreamingQueryException):
        start_once_stream(stream, "once", path, out, True, fail_once).awaitTermination()
    start_once_stream(stream, "once", path, out, True, fail_once).awaitTermination()
    assert seen.count(fails_at) == 2 and len(set(seen)) == len(seen) - 1
    plain = str(tmp_path / "plain")
    start_once_stream(stream, "plain", checkpoint_path(spark, job, "plain"), plain, True).awaitTermination()
    got = sorted(map(tuple, once_table(spark, out, stream).collect()))
    assert got and got == sorted(map(tuple, once_table(spark, plain, stream).collect()))
    # A stream begun anew beside it writes beside it.
    start_once_stream(stream, "anew", checkpoint_path(spark, job, "anew"), out, True).awaitTermination()
    assert once_table(spark, out, stream).count() == 2 * len(got)


def test_metrics_outlast_the_reports_of_a_stream(spark, tmp_path, job):
    source, path = str(tmp_path / "in"), str(tmp_path / "metrics")
    listener = MetricsTable(spark, path)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    spark.streams.addListener(listener)
    try:
        for part in (FILES, [[("f", 301_000)], [("late", 1_000)], [("g", 302_000)], [("late", 2_000)]]):
            for rows in part:
                record_file(spark, source, rows)
            query = start_once_stream(
                messages(spark, source), "counted", checkpoint_path(spark, job, "traffic"),
                str(tmp_path / "out"), True)
            query.awaitTermination()
            assert listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set(key, before)
    total = stream_totals(spark, path).collect()
    assert len(total) == 1 and total[0]["name"] == "counted"
    assert total[0]["input_rows"] == sum(map(len, FILES)) + 4
    assert total[0]["late_rows"] == 3 and late_rows(query) < 3
    assert total[0]["batches"] == batch_metrics(spark, path).select("batch_id").distinct().count() >= 8
