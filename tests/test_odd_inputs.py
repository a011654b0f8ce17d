"""Inputs that tidy tables do not hold: folders, quotes, large doubles, joins, bad positions, zones."""

import pandas as pd
from pyspark.sql import functions as F

from lanewatch.functions.times import iso_instant
from lanewatch.operators.filters import where_equals
from lanewatch.operators.matching import radius_join, with_place_name
from lanewatch.operators.sorting import sort_terms
from lanewatch.sinks.tables import write_csv_table
from lanewatch.sources.tables import read_csv_table
from workload.feed import table_stream


def test_a_stream_reads_a_folder_table_and_a_file(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(7).write.parquet(str(tmp_path / "other.parquet"))
    for folder, count in ((str(tmp_path), 100), ("/root/testdata/sf0.001", None)):
        name = f"s{abs(hash(folder))}"
        stream = table_stream(spark, folder, "events").writeStream.format("memory").queryName(
            name).trigger(availableNow=True).start()
        stream.awaitTermination(60)
        whole = spark.read.parquet(f"{folder}/events.parquet").count()
        assert spark.table(name).count() == whole == (count or whole) > 0


def test_csv_keeps_quotes_blanks_and_line_breaks(spark, tmp_path):
    texts = ['say "hi", ok', "  padded  ", "a\\b", "two\nlines", "plain"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    write_csv_table(frame, str(tmp_path / "own"))
    back = read_csv_table(spark, str(tmp_path / "own"), frame.schema, multi_line=True)
    assert [r["t"] for r in back.orderBy("k").collect()] == texts
    pd.DataFrame({"k": range(5), "t": texts}).to_csv(tmp_path / "p.csv", index=False)
    back = read_csv_table(spark, str(tmp_path / "p.csv"), frame.schema, multi_line=True)
    assert [r["t"] for r in back.orderBy("k").collect()] == texts


def test_equality_on_large_and_small_doubles(spark):
    values = [12345678.0, 1700000000.25, 0.0005, 1e-05, 1e22, 2.5]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for value in values:
        assert [r["v"] for r in where_equals(frame, "v", repr(value)).collect()] == [value]
    assert where_equals(frame, "v", "2.50").count() == 0


def test_sort_after_a_join_of_files(spark):
    sf = "/root/testdata/sf0.001"
    joined = spark.read.parquet(f"{sf}/lineitem.parquet").join(
        spark.read.parquet(f"{sf}/orders.parquet"), F.col("l_orderkey") == F.col("o_orderkey"))
    keys = [r[0] for r in sort_terms(joined, "o_totalprice.0").select("o_totalprice").collect()]
    assert keys == sorted(keys, reverse=True) and len(keys) > 0


def test_impossible_positions_match_nothing_and_stop_nothing(spark):
    inf, nan = float("inf"), float("nan")
    events = spark.createDataFrame(
        [(43.3, 21.9), (1e300, 21.9), (1e17, 0.0), (inf, 0.0), (43.3, inf), (nan, nan), (None, 1.0)],
        "vehicle_lat double, vehicle_lon double")
    places = spark.createDataFrame(
        [(43.3, 21.9, "a"), (None, 1.0, "b"), (1e300, 0.0, "c")],
        "location_lat double, location_lon double, name string")
    assert [r["name"] for r in radius_join(events, places).collect()] == ["a"]


def test_two_places_at_one_position_give_one_name(spark):
    places = spark.createDataFrame([(1.0, 2.0, "b"), (1.0000001, 2.0, "a")],
                                   "location_lat double, location_lon double, name string")
    rows = spark.createDataFrame([(1.0, 2.0), (5.0, 6.0)], "location_x double, location_y double")
    named = with_place_name(rows, places).orderBy("location_x").collect()
    assert [r["place_name"] for r in named] == ["a", "5.0, 6.0"]


def test_time_texts_are_utc_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    texts = {}
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            frame = spark.sql("select timestamp_millis(v) t from values (1777593600000L), (-250L) x(v)")
            texts[zone] = [r[0] for r in frame.select(iso_instant(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert texts["UTC"] == texts["America/New_York"] == [
        "2026-05-01T00:00:00Z", "1969-12-31T23:59:59.750Z"]
