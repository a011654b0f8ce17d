"""Radius join against brute force, place names, rings."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lanewatch.functions.geo import circle_ring, haversine_m, latitude_cosine, within_m
from lanewatch.functions.values import rounded_half_up
from lanewatch.operators.matching import radius_join, with_place_name
from lanewatch.places import PLACES, places_table

R = 6_371_000.0


def metres(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (*a, *b))
    chord = math.sin((la2 - la1) / 2) ** 2 + (
        math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2)
    return 2 * R * math.asin(min(1.0, math.sqrt(chord)))


def scattered(rng, centre, spread_m, n):
    lat, lon = centre
    points = []
    for _ in range(n):
        la = max(-90.0, min(90.0, lat + rng.uniform(-1, 1) * math.degrees(spread_m / R)))
        width = math.degrees(spread_m / R) / max(0.0005, math.cos(math.radians(la)))
        lo = lon + rng.uniform(-1, 1) * min(180.0, width)
        points.append((la, (lo + 180) % 360 - 180))
    return points


@pytest.mark.parametrize("centre, radius", [
    ((43.32, 21.9), 200.0), ((0.0, 0.0), 500.0), ((89.999, 10.0), 300.0), ((-89.9995, 0.0), 90.0),
    ((60.0, 180.0), 200.0), ((-45.0, -179.9995), 1000.0), ((84.0, 20.0), 100_000.0),
    ((20.0, 5.0), 3_000_000.0), ((10.0, 10.0), 20_100_000.0),
])
@pytest.mark.parametrize("salts", [1, 3])
def test_radius_join_equals_brute_force(spark, centre, radius, salts):
    rng = random.Random(f"{centre}{radius}")
    events = scattered(rng, centre, radius * 3, 150)
    places = scattered(rng, centre, radius * 3, 40) + [events[0]]
    wanted = sorted((i, j) for i, e in enumerate(events) for j, p in enumerate(places)
                    if metres(e, p) <= radius)
    left = spark.createDataFrame(
        [(i, *e) for i, e in enumerate(events)], "i int, vehicle_lat double, vehicle_lon double")
    right = spark.createDataFrame(
        [(j, *p) for j, p in enumerate(places)], "j int, location_lat double, location_lon double")
    got = radius_join(left, right, radius, salts=salts)
    assert sorted((r["i"], r["j"]) for r in got.collect()) == wanted
    assert wanted


def test_radius_is_inclusive_and_nulls_never_match(spark):
    step = math.degrees(200.0 / R)
    distance = metres((10.0, 20.0), (10.0 + step, 20.0))
    left = spark.createDataFrame(
        [(1, 10.0 + step, 20.0), (2, None, 20.0), (3, 10.0, None), (4, float("nan"), 20.0)],
        "i int, vehicle_lat double, vehicle_lon double")
    place = spark.createDataFrame([(10.0, 20.0)], "location_lat double, location_lon double")
    assert [r["i"] for r in radius_join(left, place, distance).collect()] == [1]
    assert radius_join(left, place, distance * 0.999).count() == 0
    with pytest.raises(ValueError):
        radius_join(left, place, 0.01)


def test_known_places_are_broadcast_and_events_stay(spark):
    events = spark.range(10_000_000).selectExpr(
        "id", "43D + id * 1e-7D as vehicle_lat", "21.9D as vehicle_lon")
    plan = radius_join(events, places_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "hashpartitioning" not in plan


def test_large_dimensions_join_by_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.createDataFrame(
            [(1, 43.323273, 21.895323)], "i int, vehicle_lat double, vehicle_lon double")
        joined = radius_join(events, places_table(spark), salts=2)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" in plan and "NestedLoop" not in plan
        assert [r["name"] for r in joined.collect()] == ["Tvrdjava"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_haversine_of_antipodes(spark):
    row = spark.range(1).select(haversine_m(
        F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("d")).first()
    assert row["d"] == pytest.approx(math.pi * R)


def test_place_names(spark):
    rows = [(43.323273, 21.895323), (43.3232734, 21.8953226), (43.33018, 21.892056), (1.5, 2.25)]
    named = with_place_name(
        spark.createDataFrame(rows, "location_x double, location_y double"), places_table(spark))
    assert [r["place_name"] for r in named.collect()] == [
        "Tvrdjava", "Tvrdjava", "Elektronski fakultet", "1.5, 2.25"]


def test_ring(spark):
    name, lat, lon = PLACES[3]
    ring = spark.range(1).select(circle_ring(F.lit(lat), F.lit(lon)).alias("r")).first()["r"]
    assert len(ring) == 65 and ring[0] == ring[64]
    assert ring[0][0] == pytest.approx(lon) and ring[0][1] > lat
    for lo, la in ring:
        assert metres((lat, lon), (la, lo)) == pytest.approx(200.0, abs=1e-6)


@pytest.mark.parametrize("how", [{"salts": 4}, {"large": True}])
def test_a_growing_dimension_is_never_broadcast(spark, tmp_path, how):
    """Its copies per cell and salt are not in Spark's estimate, so the driver would hold them."""
    spark.range(2000).selectExpr(
        "id", "43.3 + id * 0.0001 location_lat", "21.85 + id * 0.0001 location_lon").write.parquet(str(tmp_path / "p"))
    places = spark.read.parquet(str(tmp_path / "p"))
    events = spark.range(2000).selectExpr(
        "id event_id", "43.3 + id * 0.0001 vehicle_lat", "21.85 + id * 0.0001 vehicle_lon")
    joined = radius_join(events, places, **how)
    assert joined.count() == radius_join(events, places).count() > 2000
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_bounds_tell_what_the_distance_tells(spark):
    """Pairs on the radius or next to it, over the poles, the date line and odd longitudes."""
    rng = random.Random(5)
    rows = []
    for lat, lon in [(43.3, 21.9), (0.0, 0.0), (89.9999, 10.0), (90.0, 0.0), (-90.0, 5.0), (60.0, 180.0),
                     (-45.0, -179.9999), (10.0, 725.0), (10.0, 1e9), (10.0, 1e300)]:
        for _ in range(100):
            scale = 10.0 ** rng.uniform(-9, 2)
            other = max(-90.0, min(90.0, lat + rng.uniform(-1, 1) * scale))
            rows.append((lat, lon, other, lon + rng.uniform(-1, 1) * scale * 2 + rng.choice([0, 0, 360, -360])))
    pairs = spark.createDataFrame(rows, "a double, b double, c double, d double").cache()
    pair = [F.col(c) for c in "abcd"]
    cosines = [latitude_cosine(F.col("a")), latitude_cosine(F.col("c"))]
    exact = haversine_m(*pair)
    found = [r["m"] for r in pairs.select(exact.alias("m")).collect()]
    for radius in [0.1, 200.0, 1e6, 1.5e7, 20_015_000.0, 2.1e7, *(m for m in found[::125] if m > 0.1)]:
        for at in (math.nextafter(radius, 0), radius, math.nextafter(radius, math.inf)):
            told = within_m(*pair, *cosines, at)
            assert pairs.where(told != (exact <= at)).count() == 0
            assert pairs.where(told).count() == sum(m <= at for m in found)


def test_rounding_by_arithmetic_is_the_rounding_of_the_text(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 0.00005, -0.00005, 1.00005, 2.34565, 0.00015, -1e-9, 199.99995, 1e5, 123456.78905, 1e15,
              -1e300, float("inf"), float("-inf"), float("nan"), None, 5e-324]
    values += [rng.uniform(0, 200) for _ in range(20000)]
    values += [rng.randrange(4_000_000) / 20000 for _ in range(20000)]  # half of them end in a half
    values += [math.nextafter(v, rng.choice([-1e9, 1e9])) for v in values[-5000:]]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        F.round("v", 4).cast("string").alias("wanted"), rounded_half_up(F.col("v"), 4).cast("string").alias("got"))
    assert rows.where("not (wanted <=> got)").count() == 0


def test_pairs_have_their_distance_taken_once_and_fill_many_tasks(spark):
    events = spark.range(5000).selectExpr(
        "id event_id", "43.3 + id * 0.00001 vehicle_lat", "21.85 + id * 0.00001 vehicle_lon")
    places = events.selectExpr("event_id place", "vehicle_lat location_lat", "vehicle_lon location_lon")
    joined = radius_join(events, places, salts=4)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    (condition,) = [line for line in plan.splitlines() if "Join Inner" in line]
    # What bounds tell comes first; the distance stands behind them, for what they leave.
    assert condition.index("<=") < condition.index("ASIN") and condition.count("ASIN") == 1
    assert plan.count("ASIN") == 2
    assert joined.rdd.getNumPartitions() >= 8 * spark.sparkContext.defaultParallelism
    assert joined.count() == radius_join(events, places).count() > 5000
