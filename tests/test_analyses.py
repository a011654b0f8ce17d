"""Batch analyses, registry, messages."""

import json
from datetime import datetime, timezone
from random import Random

import pytest
from pyspark.sql import functions as F

from lanewatch.places import PLACES
from lanewatch.plans import analyses as an
from lanewatch.plans.messages import parse_messages, result_messages
from lanewatch.schemas import POLLUTANTS
from lanewatch.streaming.windows import WindowSpec

BASE = 1_777_593_600_000
NAME, LAT, LON = PLACES[0]


def positions(spark, rows):
    """(vehicle, seconds) pairs at the first place."""
    return spark.createDataFrame(
        [(v, LAT, LON, BASE + int(s * 1000)) for v, s in rows],
        "vehicle_id string, vehicle_lat double, vehicle_lon double, ms long",
    ).withColumn("event_time", F.timestamp_millis("ms")).drop("ms")


def counts(df):
    return {(r["s"], r["e"]): r["distinct_cars_count"] for r in df.selectExpr(
        f"(unix_millis(window_start) - {BASE}) div 1000 as s",
        f"(unix_millis(window_end) - {BASE}) div 1000 as e", "distinct_cars_count").collect()}


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_distinct_vehicles_per_tumbling_window(spark, mode):
    df = positions(spark, [("a", 0), ("a", 59.999), ("b", 10), (None, 20), ("a", 60), ("c", 500)])
    assert counts(an.traffic(df, mode=mode)) == {(0, 60): 2, (60, 120): 1, (480, 540): 1}


def test_sliding_windows(spark):
    got = counts(an.traffic(positions(spark, [("a", 65), ("b", 70)]), WindowSpec("SLIDING")))
    assert got == {(10, 70): 1, (20, 80): 2, (30, 90): 2, (40, 100): 2, (50, 110): 2,
                   (60, 120): 2, (70, 130): 1}


@pytest.mark.parametrize("length,slide", [
    ("60 seconds", "10 seconds"), ("60 seconds", "60 seconds"), ("45 seconds", "10 seconds"),
    ("2 seconds", "250 milliseconds"), ("30 seconds", "15 seconds")])
def test_sliding_counts_equal_plain_grouping(spark, length, slide):
    random = Random(7)
    rows = [(random.choice(["a", "b", "c", None]), *random.choice(PLACES[:3])[1:],
             BASE + random.choice([0, 3_600_000, -5_000]) + random.randrange(400_000))
            for _ in range(60)] + [("z", LAT, LON, BASE + 60_000)] * 3 + [("z", LAT, LON, None)]
    df = spark.createDataFrame(
        rows, "vehicle_id string, vehicle_lat double, vehicle_lon double, ms long",
    ).withColumn("event_time", F.timestamp_millis("ms")).drop("ms")
    spec = WindowSpec("sliding", length, slide)
    windowed = an.match_to_places(df, None, spec).withColumn("window", spec.column())
    plain = windowed.groupBy("window", "location_lat", "location_lon").agg(
        F.count_distinct("vehicle_id").alias("n")).select(
        "window.start", "window.end", "location_lat", "location_lon", "n")
    got = an.traffic(df, spec).drop("analysis_type")
    assert got.dtypes[:2] == [("window_start", "timestamp"), ("window_end", "timestamp")]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_sliding_counts_repeat_no_sighting(spark, capsys):
    df = positions(spark, [("a", 65), ("b", 70)])
    an.traffic(df, WindowSpec("sliding")).explain("formatted")
    assert "Expand" not in capsys.readouterr().out
    an.traffic(df, WindowSpec("sliding", "45 seconds")).explain("formatted")
    assert "Expand" in capsys.readouterr().out


def test_only_null_vehicles_give_a_zero_row_either_way(spark):
    df = positions(spark, [(None, 0)])
    assert counts(an.traffic(df)) == counts(an.traffic(df, mode="approx")) == {(0, 60): 0}


def emissions(spark, values):
    rows = [("v", LAT, LON, BASE, *(v for _ in POLLUTANTS)) for v in values]
    schema = "vehicle_id string, vehicle_lat double, vehicle_lon double, ms long, " + ", ".join(
        f"{p} double" for p in POLLUTANTS)
    return spark.createDataFrame(rows, schema).withColumn(
        "event_time", F.timestamp_millis("ms")).drop("ms")


def test_means_over_nulls(spark):
    df = emissions(spark, [1.0, None, 4.0])
    assert an.pollution(df).first()["avg_nox"] == 2.5
    zero = an.pollution(df, null_policy="as_zero").first()
    assert zero["avg_nox"] == pytest.approx(5 / 3) and zero["max_nox"] == 4.0
    nothing = emissions(spark, [None, None])
    assert an.pollution(nothing).first()["avg_co2"] is None
    zero = an.pollution(nothing, null_policy="as_zero").first()
    assert zero["avg_co2"] == 0.0 and zero["max_co2"] is None


@pytest.mark.parametrize("policy", ["skip", "as_zero"])
@pytest.mark.parametrize("length, slide", [("60 seconds", "10 seconds"), ("25 seconds", "10 seconds"),
                                           ("1 minute", "20 seconds")])
def test_sliding_means_equal_plain_grouping(spark, policy, length, slide):
    """Per-slide sums, where they are used, change nothing but the order of adding."""
    df = spark.range(300).select(
        F.concat(F.lit("v"), F.col("id") % 9).alias("vehicle_id"),
        F.lit(LAT).alias("vehicle_lat"), F.lit(LON).alias("vehicle_lon"),
        F.timestamp_millis(F.lit(BASE) + (F.col("id") * 7919) % 200_000).alias("event_time"),
        *(F.when(F.col("id") % (i + 2) != 0, F.col("id") * (i + 0.5)).alias(p)
          for i, p in enumerate(POLLUTANTS)))
    got = an.pollution(df, WindowSpec("sliding", length, slide), null_policy=policy)
    plain = df.groupBy(F.window("event_time", length, slide)).agg(*(
        (F.avg(p) if policy == "skip" else F.coalesce(F.sum(p), F.lit(0.0)) / F.count("*"))
        .alias(f"avg_{p}") for p in POLLUTANTS), *(F.max(p).alias(f"max_{p}") for p in POLLUTANTS))
    wanted = {r["window"]["start"]: r for r in plain.collect()}
    rows = got.collect()
    assert len(rows) == len(wanted)
    for row in rows:
        for name in [f"{part}_{p}" for part in ("avg", "max") for p in POLLUTANTS]:
            assert row[name] == pytest.approx(wanted[row["window_start"]][name]), name


def test_sliding_means_of_nothing(spark):
    sliding = WindowSpec("sliding")
    rows = an.pollution(emissions(spark, [None]), sliding).collect()
    assert len(rows) == 6 and all(r["avg_co2"] is None and r["max_co2"] is None for r in rows)
    rows = an.pollution(emissions(spark, [None]), sliding, null_policy="as_zero").collect()
    assert all(r["avg_co2"] == 0.0 for r in rows)


def test_unknown_settings_are_errors(spark):
    df = positions(spark, [("a", 0)])
    for call in (
        lambda: an.traffic(df, WindowSpec("session")), lambda: an.traffic(df, mode="guess"),
        lambda: an.traffic(df, WindowSpec("sliding", slide=None)),
        lambda: an.pollution(emissions(spark, [1.0]), null_policy="x"),
        lambda: an.active_analyses([]), lambda: an.active_analyses(["traffic", "noise"]),
        lambda: an.active_analyses(["traffic"], {"pollution": "E"}),
    ):
        with pytest.raises(ValueError):
            call()


def test_registry_takes_new_analyses(spark):
    def events_in_total(records, topic, spec):
        return records.filter(F.col("topic") == topic).agg(F.count("*").alias("n")).selectExpr(
            "timestamp '2026-05-01 00:00:00' as window_start",
            "timestamp '2026-05-01 00:01:00.250' as window_end",
            "1.5D as location_x", "2.5D as location_y", "n", "'total' as analysis_type")

    an.register_analysis("total", events_in_total)
    try:
        records = spark.createDataFrame([("k", "{}", "T")], "key string, value string, topic string")
        row = an.analyse_records(records, ["total"], topics={"total": "T"}).first()
        assert row["key"] == "total/2026-05-01T00:00:00Z/2026-05-01T00:01:00.250Z/1.5/2.5"
        assert json.loads(row["value"])["n"] == 1
    finally:
        an._ANALYSES.pop("total")


def test_config_texts():
    assert an.topic_mapping("traffic:FCD;pollution:EMISSIONS") == an.DEFAULT_TOPICS
    assert an.analysis_names("traffic, pollution") == ["traffic", "pollution"]


def test_messages_have_explicit_nulls_and_parse_back(spark):
    result = an.pollution(emissions(spark, [None]))
    row = result_messages(result, "pollution").first()
    assert row["key"] == f"pollution/2026-05-01T00:00:00Z/2026-05-01T00:01:00Z/{LAT}/{LON}"
    value = json.loads(row["value"])
    assert list(value) == result.columns and value["avg_co2"] is None
    assert value["window_end"] == "2026-05-01T00:01:00Z" and value["location_x"] == LAT
    back = parse_messages(result_messages(result, "pollution")).first()
    assert back["analysis_type"] == "pollution" and back["distinct_cars_count"] is None


def test_union_keeps_every_message(spark):
    parts = [result_messages(an.traffic(positions(spark, [("a", 0)])), "traffic")] * 3
    assert an.union_results(parts).count() == 3


def test_a_crowded_place_is_counted_by_many_tasks(spark):
    """The first shuffle of the exact count spreads by vehicle."""
    plan = an.traffic(positions(spark, [("a", 0)]))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and "vehicle_id" in exchanges[1]
