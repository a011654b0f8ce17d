"""Streams: lateness, restart, equality with batch."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from lanewatch.places import FCD_TOPIC, PLACES
from lanewatch.plans.analyses import traffic
from lanewatch.plans.events import (
    decode_records, observe_malformed, positions_from_records, vehicle_positions,
)
from lanewatch.plans.messages import result_messages
from lanewatch.sources.topics import record_files, result_table
from lanewatch.streaming.runner import (
    checkpoint_path, late_rows, start_analyses, start_stream, start_union,
)
from lanewatch.streaming.windows import WindowSpec

_, LAT, LON = PLACES[0]


def record_file(spark, folder, rows):
    """Add one file of (vehicle, milliseconds) position records."""
    value = F.to_json(F.struct(
        F.col("v").alias("vehicleId"), F.lit(LON).alias("x"), F.lit(LAT).alias("y"),
        F.col("ms").alias("timestamp")))
    spark.createDataFrame(rows, "v string, ms long").select(
        F.col("v").alias("key"), value.alias("value"), F.lit(FCD_TOPIC).alias("topic"),
        F.timestamp_millis("ms").alias("timestamp"),
    ).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


def run(spark, source, out, job, spec=WindowSpec(), names=("traffic",)):
    streams = start_analyses(
        spark, lambda topic: record_files(spark, source, maxFilesPerTrigger="1"), names, job,
        "parquet", lambda name: {"path": f"{out}/{name}"}, spec, available_now=True,
        state_partitions=3)
    for stream in streams:
        stream.awaitTermination()
    return streams


def windows(spark, path):
    return sorted((r["window_start"][11:19], r["distinct_cars_count"])
                  for r in result_table(spark, path).collect())


FILES = [
    [("a", 1_000), ("c", 130_000)], [("late2", 59_000), ("d", 131_000)],
    [("late3", 58_000), ("d3", 132_000)], [("e", 300_000)],
]


@pytest.fixture
def job():
    return f"lanewatch-tests/{uuid.uuid4().hex}"


def test_late_vehicles(spark, tmp_path, job):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in FILES:
        record_file(spark, source, rows)
    streams = run(spark, source, out, job)
    assert windows(spark, f"{out}/traffic") == [("00:00:00", 2), ("00:02:00", 3)]
    assert late_rows(streams[0]) >= 1
    assert streams[0].name == "traffic"
    operators = streams[0].recentProgress[-1].stateOperators
    assert {o.numShufflePartitions for o in operators} == {3}
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_late_vehicles_dropped_at_once(spark, tmp_path, job):
    """With one stateful step the current watermark can be held against each row."""
    setting = "spark.sql.streaming.statefulOperator.allowMultiple"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in FILES:
        record_file(spark, source, rows)
    spark.conf.set(setting, "false")
    try:
        positions = positions_from_records(record_files(spark, source, maxFilesPerTrigger="1"))
        stream = start_stream(
            result_messages(traffic(positions, mode="approx"), "traffic"), "approx",
            checkpoint_path(spark, job, "traffic"), "parquet", {"path": out},
            available_now=True)
        stream.awaitTermination()
    finally:
        spark.conf.unset(setting)
    assert windows(spark, out) == [("00:00:00", 1), ("00:02:00", 3)]
    assert late_rows(stream) == 2


def test_malformed_records_are_counted_per_batch(spark, tmp_path, job):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    record_file(spark, source, [("a", 1_000), ("b", None)])
    spark.read.parquet(source).withColumn("value", F.lit("{cut")).coalesce(1).write.parquet(
        source + "2")
    spark.read.parquet(source, source + "2").coalesce(1).write.parquet(source + "3")
    seen = observe_malformed(
        decode_records(record_files(spark, source + "3"), FCD_TOPIC, "fcd"), "fcd")
    stream = start_stream(
        result_messages(traffic(vehicle_positions(seen)), "traffic"), "seen",
        checkpoint_path(spark, job, "seen"), "parquet", {"path": out}, available_now=True)
    stream.awaitTermination()
    first = stream.recentProgress[0].observedMetrics["fcd"]
    assert (first["records"], first["malformed"]) == (4, 3)


def test_a_restart_resumes(spark, tmp_path, job):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    record_file(spark, source, [("a", 1_000), ("b", 2_000)])
    run(spark, source, out, job)
    assert windows(spark, f"{out}/traffic") == []
    record_file(spark, source, [("b", 3_000), ("c", 200_000)])
    run(spark, source, out, job)
    assert windows(spark, f"{out}/traffic") == [("00:00:00", 2)]
    run(spark, source, out, job)
    assert windows(spark, f"{out}/traffic") == [("00:00:00", 2)]


@pytest.mark.parametrize("kind", ["tumbling", "sliding"])
def test_stream_equals_batch_for_closed_windows(spark, tmp_path, job, kind):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for start in range(0, 400, 100):
        record_file(spark, source, [
            (f"v{i % 17}", (start + i % 100) * 1000 + i) for i in range(start, start + 300)])
    spec = WindowSpec(kind)
    run(spark, source, out, job, spec)
    batch = traffic(positions_from_records(spark.read.parquet(source)), spec)
    last = max(
        (start + i % 100) * 1000 + i for start in range(0, 400, 100)
        for i in range(start, start + 300))
    closed = batch.filter(F.unix_millis("window_end") <= last - 30_000)
    got = sorted((r["window_start"], r["window_end"], r["distinct_cars_count"])
                 for r in result_table(spark, f"{out}/traffic").collect())
    pattern = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    wanted = sorted(tuple(r) for r in closed.select(
        F.date_format("window_start", pattern), F.date_format("window_end", pattern),
        "distinct_cars_count").collect())
    assert got == wanted and len(got) > 4


def test_union_stream_has_both_analyses(spark, tmp_path, job):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    record_file(spark, source, [("a", 1_000), ("b", 200_000)])
    emission = spark.read.parquet(source).withColumn("topic", F.lit("EMISSIONS"))
    emission.coalesce(1).write.mode("append").parquet(source + "2")
    spark.read.parquet(source, source + "2").coalesce(1).write.parquet(source + "3")
    start_union(
        spark, record_files(spark, source + "3"), ["traffic", "pollution"], job, "parquet",
        {"path": out}, available_now=True).awaitTermination()
    kinds = {r["analysis_type"]: r["distinct_cars_count"]
             for r in result_table(spark, out).collect()}
    assert kinds == {"traffic": 1, "pollution": None}


def test_wrong_settings_start_nothing(spark, tmp_path, job):
    source = str(tmp_path / "in")
    record_file(spark, source, [("a", 1_000)])
    with pytest.raises(ValueError):
        run(spark, source, str(tmp_path / "out"), job, WindowSpec("hopping"))
    with pytest.raises(ValueError):
        run(spark, source, str(tmp_path / "out"), job, names=("traffic", "noise"))
    assert not spark.streams.active
