"""Sketches that are stored and merged."""

import pytest
from pyspark.sql import functions as F

from lanewatch.operators.sketches import (
    KLL_RANK_ERROR, distinct_sketches, merged_distinct, merged_quantile, quantile_sketches, rank_errors,
)
from lanewatch.places import PLACES
from lanewatch.plans.analyses import traffic
from lanewatch.streaming.windows import WindowSpec

BASE = 1_777_593_600
KEYS = ["window_start", "window_end", "location_x", "location_y"]


def positions(spark, n, vehicles):
    """Sightings at two places over three minutes, by a rule."""
    lat, lon = (F.when(F.col("id") % 3 == 0, a).otherwise(b)
                for a, b in zip(PLACES[0][1:], PLACES[1][1:]))
    return spark.range(n).select(
        F.when(F.col("id") % 97 != 0, F.format_string("v%d", F.col("id") * 7919 % vehicles)).alias(
            "vehicle_id"),
        lat.alias("vehicle_lat"), lon.alias("vehicle_lon"),
        F.timestamp_seconds(F.lit(BASE) + F.col("id") * 31 % 180).alias("event_time"))


@pytest.mark.parametrize("spec", [
    WindowSpec(), WindowSpec("sliding"), WindowSpec("sliding", "30 seconds", "20 seconds")])
def test_merged_panes_estimate_every_window(spark, tmp_path, spec):
    events = positions(spark, 60_000, 9_000)
    distinct_sketches(events).write.parquet(str(tmp_path / "panes"))
    merged = merged_distinct(spark.read.parquet(str(tmp_path / "panes")), spec)
    rows = traffic(events, spec).join(merged, KEYS, "full").collect()
    assert len(rows) > 4
    for row in rows:
        exact, near = row["distinct_cars_count"], row["distinct_cars_estimate"]
        assert abs(exact - near) <= 5 * 1.04 / 2**6 * exact  # five standard errors


def test_few_vehicles_are_counted_exactly_and_null_ids_not(spark):
    events = positions(spark, 600, 40)
    rows = traffic(events).join(merged_distinct(distinct_sketches(events)), KEYS, "full").collect()
    assert rows and all(r["distinct_cars_count"] == r["distinct_cars_estimate"] for r in rows)
    whole = merged_distinct(distinct_sketches(events), period=F.lit("all")).collect()
    assert all(0 < r["distinct_cars_estimate"] <= 40 for r in whole) and len(whole) == 2
    assert merged_distinct(distinct_sketches(events.limit(0))).collect() == []


def test_a_window_that_cuts_panes_is_an_error(spark):
    sketches = distinct_sketches(positions(spark, 600, 40), pane="20 seconds")
    with pytest.raises(Exception, match="within a pane"):
        merged_distinct(sketches, WindowSpec("tumbling", "30 seconds")).collect()


@pytest.mark.parametrize("rank", [0.0, 0.25, 0.5, 0.99])
def test_merged_quantiles_by_counting(spark, rank):
    rows = spark.range(200_000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") % 16).alias("part"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan")).otherwise(
            F.pow(F.col("id") * 7919 % 100_003, F.lit(2.0))).alias("v"))
    answers = merged_quantile(quantile_sketches(rows, ["g", "part"], "v"), ["g"], rank)
    found = rank_errors(rows, answers, ["g"], "v", rank).join(answers, "g").collect()
    assert len(found) == 3
    for row in found:
        assert row["rows"] == row["values"]
        assert row["rank_error"] <= KLL_RANK_ERROR


def test_quantiles_of_ties_and_nothing(spark):
    rows = spark.createDataFrame(
        [("a", 5.0)] * 50 + [("b", None), ("c", 1.0), (None, 2.0)], "g string, v double")
    answers = merged_quantile(quantile_sketches(rows, ["g"], "v"), ["g"], 0.5)
    assert {(r["g"], r["values"], r["quantile"]) for r in answers.collect()} == {
        ("a", 50, 5.0), ("c", 1, 1.0), (None, 1, 2.0)}
    errors = rank_errors(rows, answers, ["g"], "v", 0.5).collect()
    assert {(r["g"], r["rank_error"]) for r in errors} == {("a", 0.0), ("c", 0.0)}
