"""Map features."""

import json

import pytest
from pyspark.sql import functions as F

from lanewatch.functions.colours import POLLUTION_SCALE, TRAFFIC_SCALE, colour_at, scale_position
from lanewatch.functions.times import epoch_seconds_to_iso, iso_instant
from lanewatch.functions.values import fixed_digits
from lanewatch.places import PLACES
from lanewatch.plans.features import (
    features, map_centre, require_usable, scale_bounds, usable_results, with_colours, with_labels,
)
from lanewatch.schemas import ANY_RESULT
from lanewatch.sinks.tables import write_features

_, LAT, LON = PLACES[1]


def results(spark, *rows):
    """Rows given as dicts of the fields that matter."""
    base = {name: None for name in ANY_RESULT.fieldNames()} | {
        "window_start": "2026-05-01T00:00:00Z", "window_end": "2026-05-01T00:01:00Z",
        "location_x": LAT, "location_y": LON, "analysis_type": "traffic"}
    return spark.createDataFrame([tuple((base | row).values()) for row in rows], ANY_RESULT)


def test_usable_rows(spark):
    df = results(
        spark, {}, {"analysis_type": "speed"}, {"analysis_type": None}, {"window_start": ""},
        {"window_start": None}, {"location_x": None}, {"location_y": None},
        {"analysis_type": "pollution"})
    assert usable_results(df).count() == 2
    with pytest.raises(ValueError, match="no usable"):
        require_usable(results(spark, {"analysis_type": "speed"}))


@pytest.mark.parametrize("counts, bounds", [
    ([None], (0.0, 1.0)), ([5], (5.0, 6.0)), ([5, None, 5], (5.0, 6.0)), ([2, 9, 4], (2.0, 9.0))])
def test_scale_bounds(spark, counts, bounds):
    df = results(spark, *({"distinct_cars_count": n} for n in counts))
    row = scale_bounds(df).first()
    assert (row["traffic_low"], row["traffic_high"]) == bounds
    assert (row["pollution_low"], row["pollution_high"]) == (0.0, 1.0)


def test_colours(spark):
    positions = [0.0, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame([(p,) for p in positions], "p double")
    got = df.select(colour_at(F.col("p"), TRAFFIC_SCALE), colour_at(F.col("p"), POLLUTION_SCALE))
    assert [tuple(r) for r in got.collect()] == [
        ("#008000ff", "#0000ffff"), ("#7fc000ff", "#4000c0ff"), ("#ffff00ff", "#800080ff"),
        ("#ff7f00ff", "#c00040ff"), ("#ff0000ff", "#ff0000ff")]


def test_scale_position_of_null_and_outside(spark):
    df = spark.createDataFrame([(None,), (1.0,), (6.0,), (99.0,)], "v double")
    got = [r[0] for r in df.select(scale_position(F.col("v"), F.lit(2.0), F.lit(10.0))).collect()]
    assert got == [0.0, 0.0, 0.5, 1.0]


def test_each_kind_has_its_own_scale(spark):
    df = results(
        spark, {"distinct_cars_count": 1}, {"distinct_cars_count": 3},
        {"analysis_type": "pollution", "avg_co2": 100.0},
        {"analysis_type": "pollution", "avg_co2": 300.0})
    assert [r["colour"] for r in with_colours(df).collect()] == [
        "#008000ff", "#ff0000ff", "#0000ffff", "#ff0000ff"]


def test_number_texts_round_as_the_exact_value_says(spark):
    values = [0.125, 2.675, 1234567.891, -0.001, 0.0, 1e15, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fixed_digits(F.col("v"))).collect()]
    assert got == [f"{v:.2f}" if v is not None else "N/A" for v in values]


def test_labels(spark):
    df = with_labels(results(
        spark, {"distinct_cars_count": 4},
        {"analysis_type": "pollution", "avg_co2": 1.005, "avg_hc": 0.12345, "max_noise": 61.25}))
    traffic, pollution = df.collect()
    assert traffic["place_name"] == PLACES[1][0] and traffic["label_kind"] == "Traffic"
    assert traffic["label_distinct_cars"] == "4" and traffic["label_avg_co2"] is None
    assert pollution["label_kind"] == "Pollution" and pollution["label_distinct_cars"] is None
    assert (pollution["label_avg_co2"], pollution["label_avg_hc"]) == (f"{1.005:.2f}", f"{0.12345:.4f}")
    assert (pollution["label_avg_noise"], pollution["label_max_noise"]) == ("N/A dB", "61.25 dB")


def test_features(spark, tmp_path):
    df = features(results(
        spark, {"distinct_cars_count": 4}, {"analysis_type": "pollution", "avg_co2": 9.0}))
    write_features(df, str(tmp_path / "f"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "f")).collect()]
    assert len(lines) == 2
    by_weight = {f["properties"]["style"]["weight"]: f for f in lines}
    traffic = by_weight[5]
    assert traffic["type"] == "Feature" and traffic["geometry"]["type"] == "Polygon"
    ring = traffic["geometry"]["coordinates"][0]
    assert len(ring) == 65 and ring[0] == ring[-1] and abs(ring[0][0] - LON) < 1e-9
    assert traffic["properties"]["time"] == "2026-05-01T00:00:00Z"
    assert traffic["properties"]["label"]["place_name"] == PLACES[1][0]
    style = traffic["properties"]["style"]
    assert style == {"color": "#008000ff", "weight": 5, "fillColor": "#008000ff",
                     "fillOpacity": 0.08, "opacity": 0.95}
    assert by_weight[1]["properties"]["style"]["fillOpacity"] == 0.35


def test_the_scale_is_computed_once(spark):
    df = features(results(spark, {"distinct_cars_count": 4}))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "Cartesian" not in plan
    assert "NestedLoop" not in plan


def test_map_centre(spark):
    df = results(spark, {"location_x": 1.0, "location_y": 5.0}, {"location_x": 2.0, "location_y": 6.0})
    assert tuple(map_centre(df).first()) == (1.5, 5.5)


def test_time_texts(spark):
    df = spark.range(1).select(
        iso_instant(F.timestamp_millis(F.lit(1_777_593_600_000))),
        iso_instant(F.timestamp_millis(F.lit(1_777_593_600_250))),
        epoch_seconds_to_iso(F.lit(1_777_593_600.0)), epoch_seconds_to_iso(F.lit(1.000001)))
    assert tuple(df.first()) == (
        "2026-05-01T00:00:00Z", "2026-05-01T00:00:00.250Z", "2026-05-01T00:00:00",
        "1970-01-01T00:00:01.000001")
