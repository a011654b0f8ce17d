"""Registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lanewatch.functions.geo import circle_ring, haversine_m
from lanewatch.functions.times import iso_instant
from lanewatch.functions.values import rounded_half_up
from lanewatch.operators.filters import (
    filter_terms, route_topic, where_equals, where_greater, where_less,
)
from lanewatch.operators.matching import radius_join, with_place_name
from lanewatch.operators.metrics import count_rows, observe_rows, rows_per
from lanewatch.operators.profile import STATS, group_profile, numeric_report
from lanewatch.operators.sketches import (
    KLL_RANK_ERROR, distinct_sketches, merged_distinct, merged_quantile, quantile_sketches, rank_errors,
)
from lanewatch.operators.sorting import sort_terms
from lanewatch.places import EMISSIONS_TOPIC, FCD_TOPIC, PLACES, places_table
from lanewatch.plans.analyses import analyse_records, pollution, traffic
from lanewatch.plans.events import (
    decode_records, emissions_from_records, event_records, malformed_counts,
    positions_from_records, vehicle_positions,
)
from lanewatch.plans.features import (
    features, map_centre, scale_bounds, usable_results, with_colours, with_labels,
)
from lanewatch.plans.layers import packet_layers
from lanewatch.plans.messages import parse_messages, result_messages
from lanewatch.plans.packets import decode_packets, number_packets, summarise_by_label
from lanewatch.schemas import FCD_EVENT, POLLUTANTS
from lanewatch.session import working_path
from lanewatch.sinks.tables import write_csv_table, write_frame_collections
from lanewatch.sources.captures import read_captures
from lanewatch.sources.tables import read_csv_table
from lanewatch.sources.topics import result_table
from lanewatch.sources.vehicle_xml import malformed_timesteps, read_vehicle_xml
from lanewatch.streaming.runner import start_analyses, start_union
from lanewatch.streaming.windows import WindowSpec
from workload import feed
from workload.feed import table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

SLIDING = WindowSpec("sliding")
RESULT_DIGITS = {"hc": 10, "pmx": 11}  # others 9
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity",
                "l_extendedprice", "l_discount")


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under a name."""

    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All doubles rounded, for comparison."""
    return df.select(*(
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema.fields))


def rounded_results(results: DataFrame) -> DataFrame:
    """Doubles rounded to where a mean of these values does not end in a 5."""
    return results.select(*(
        F.round(f.name, RESULT_DIGITS.get(f.name[4:], 9)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in results.schema.fields))


def shown(results: DataFrame) -> DataFrame:
    """Window bounds as text, doubles rounded."""
    return rounded_results(results.withColumns({
        "window_start": iso_instant(F.col("window_start")),
        "window_end": iso_instant(F.col("window_end")),
    }))


# --- tables ----------------------------------------------------------------

@query("filter_eq_ci")
def filter_eq_ci(spark, sf_dir):
    return where_equals(table(spark, sf_dir, "lineitem"), "l_returnflag", "a").select(*LINE_COLUMNS)


@query("filter_eq_integer")
def filter_eq_integer(spark, sf_dir):
    return where_equals(table(spark, sf_dir, "lineitem"), "l_linenumber", "3").select(*LINE_COLUMNS)


@query("filter_eq_missing")
def filter_eq_missing(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    return where_equals(lines, "l_returnflag", "nan").select(*LINE_COLUMNS)


@query("filter_gt")
def filter_gt(spark, sf_dir):
    return where_greater(table(spark, sf_dir, "lineitem"), "l_quantity", 30).select(*LINE_COLUMNS)


@query("filter_gt_text")
def filter_gt_text(spark, sf_dir):
    text = F.when(F.col("l_linenumber") % 3 == 0, "n/a").otherwise(
        F.concat(F.lit(" "), F.col("l_quantity").cast("string")))
    lines = table(spark, sf_dir, "lineitem").withColumn("quantity_text", text)
    return where_greater(lines, "quantity_text", 30.5).select(
        "l_orderkey", "l_linenumber", "quantity_text")


@query("filter_lt")
def filter_lt(spark, sf_dir):
    return where_less(table(spark, sf_dir, "orders"), "o_totalprice", 100000).select(*ORDER_COLUMNS)


@query("filter_conjunction")
def filter_conjunction(spark, sf_dir):
    terms = "l_returnflag=r, l_quantity>10,l_discount<0.05"
    return filter_terms(table(spark, sf_dir, "lineitem"), terms).select(*LINE_COLUMNS)


@query("sort_multi")
def sort_multi(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    return sort_terms(orders, "o_orderstatus.1,o_totalprice.0")


@query("count_rows")
def count_filtered_rows(spark, sf_dir):
    kept = filter_terms(table(spark, sf_dir, "lineitem"), "l_quantity>10,l_linestatus=o")
    return count_rows(sort_terms(kept, "l_quantity.0"))


def shown_profile(df: DataFrame) -> DataFrame:
    return rounded(df, 4)


@query("group_profile")
def group_profile_stats(spark, sf_dir):
    return shown_profile(group_profile(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"],
        ["l_quantity", "l_extendedprice"]))


@query("group_profile_single_pass")
def group_profile_single_pass(spark, sf_dir):
    return shown_profile(group_profile(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"],
        ["l_quantity", "l_extendedprice"], median="single_pass"))


@query("group_profile_null_keys")
def group_profile_null_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumns({
        "flag": F.nullif("l_returnflag", F.lit("N")),
        "discounted": F.when(F.col("l_discount") > 0.05, F.col("l_quantity")),
        "nothing": F.when(F.col("l_returnflag") == "R", F.col("l_tax")),
    })
    return shown_profile(group_profile(lines, ["flag"], ["discounted", "nothing"]))


@query("group_profile_many_groups")
def group_profile_many_groups(spark, sf_dir):
    return shown_profile(group_profile(
        table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_quantity", "l_linenumber"]))


@query("group_profile_one_group")
def group_profile_one_group(spark, sf_dir):
    """Every line in one group."""
    lines = table(spark, sf_dir, "lineitem").withColumn("everything", F.lit(1))
    return shown_profile(group_profile(lines, ["everything"], ["l_extendedprice"]))


@query("group_median_approx")
def group_median_approx(spark, sf_dir):
    """The sketch's median lies between the 0.45 and 0.55 quantiles."""
    keys = ["l_returnflag", "l_linestatus"]
    lines = table(spark, sf_dir, "lineitem")
    sketched = group_profile(lines, keys, ["l_extendedprice"], median="approx", check=False)
    # Counted, so that no task holds a group's values.
    errors = rank_errors(lines, sketched, keys, "l_extendedprice", 0.5, "l_extendedprice_median")
    return sketched.join(errors, keys).select(
        *keys, "l_extendedprice_count", (F.col("rank_error") <= 0.05).alias("median_close"))


@query("group_median_sketch")
def group_median_sketch(spark, sf_dir):
    """Quantile sketches per group and supplier nation, stored, then merged over the nations.

    The merged sketch's median lies within the stated rank error, by counting.
    """
    keys = ["l_returnflag", "l_linestatus"]
    lines = table(spark, sf_dir, "lineitem").withColumn("part", F.col("l_suppkey") % 25)
    path = working_path(spark, "quantile-sketches")
    quantile_sketches(lines, [*keys, "part"], "l_extendedprice").write.parquet(path)
    answers = merged_quantile(spark.read.parquet(path), keys, 0.5)
    errors = rank_errors(lines, answers, keys, "l_extendedprice", 0.5)
    return answers.join(errors, keys).select(
        *keys, "values", "rows", (F.col("rank_error") <= KLL_RANK_ERROR).alias("median_close"))


@query("numeric_validation")
def numeric_validation(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn(
        "mixed", F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal").cast("string"))
        .otherwise(F.col("c_name")))
    return numeric_report(
        customers, ["c_name", "c_acctbal", "c_nationkey", "c_mktsegment", "mixed"])


@query("run_metrics")
def run_metrics(spark, sf_dir):
    """Rows read, filtered out and written by one filter job."""
    read, rows_in = observe_rows(
        table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), f"read-{uuid.uuid4().hex}")
    kept, rows_out = observe_rows(
        filter_terms(read, "l_returnflag=a,l_quantity>20"), f"kept-{uuid.uuid4().hex}")
    kept.write.format("noop").mode("overwrite").save()
    seen, written = rows_in.get["rows"], rows_out.get["rows"]
    return spark.range(1).select(
        F.lit(seen).cast("long").alias("rows_read"),
        F.lit(seen - written).cast("long").alias("rows_filtered"),
        F.lit(written).cast("long").alias("rows_written"))


@query("csv_round_trip")
def csv_round_trip(spark, sf_dir):
    path = working_path(spark, "csv")
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS).withColumn(
        "l_returnflag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
        .otherwise(F.when(F.col("l_linenumber") % 2 == 0, "n/a")))
    write_csv_table(lines, path)
    return read_csv_table(spark, path, lines.schema)


# --- packets ---------------------------------------------------------------

def packets(spark, sf_dir) -> DataFrame:
    return decode_packets(feed.packet_frames(table(spark, sf_dir, "events")))


@query("packet_decode")
def packet_decode(spark, sf_dir):
    return rounded(packets(spark, sf_dir))


@query("packet_labels")
def packet_labels(spark, sf_dir):
    return summarise_by_label(packets(spark, sf_dir))


@query("packet_sequence")
def packet_sequence(spark, sf_dir):
    frames = feed.packet_frames(table(spark, sf_dir, "events"))
    placed = frames.select(
        "file_name", F.col("packet_no").alias("expected_no"),
        (F.lit(24) + F.col("packet_no") * 100).alias("offset"))
    return number_packets(placed, step=1 << 16).select("file_name", "packet_no", "offset")


@query("packet_capture_scan")
def packet_capture_scan(spark, sf_dir):
    """Captures written from the events, read back in small byte ranges."""
    folder = working_path(spark, "captures")
    feed.write_captures(feed.packet_frames(table(spark, sf_dir, "events")), folder)
    read = read_captures(spark, folder, split_bytes=64 * 1024)
    return rounded(decode_packets(read).select(
        "file_name", "packet_no", "timestamp", "protocol", "length", "src_port", "payload_len"))


@query("packet_block_capture_scan")
def packet_block_capture_scan(spark, sf_dir):
    """Block-format captures of all packets, read back in small ranges."""
    folder = working_path(spark, "block-captures")
    feed.write_captures(feed.packet_frames(table(spark, sf_dir, "events")), folder, blocks=True)
    read = read_captures(spark, folder, split_bytes=64 * 1024, form="block")
    return rounded(decode_packets(read).select(
        "file_name", "packet_no", "timestamp", "protocol", "length", "src_port", "payload_len"))


@query("packet_layers")
def layered_packets(spark, sf_dir):
    return packet_layers(feed.layered_frames(table(spark, sf_dir, "events"))).select(
        "file_name", "packet_no", "layers", "last_layer", "protocol", "src_ip", "dst_ip", "ttl",
        "dst_port", "tcp_flags", "payload_len", "length")


@query("packet_filter_sort")
def packet_filter_sort(spark, sf_dir):
    kept = filter_terms(packets(spark, sf_dir), "protocol=tcp,length>80,dst_port=443")
    return sort_terms(kept, "src_ip.1,length.0").select(
        "file_name", "packet_no", "src_ip", "dst_ip", "dst_port", "length", "tcp_flags")


@query("packet_profile")
def packet_profile(spark, sf_dir):
    return shown_profile(group_profile(
        packets(spark, sf_dir), ["label", "protocol"], ["length", "payload_len", "ttl"],
        check=False))


# --- ingest ----------------------------------------------------------------

def ingested_xml(spark, sf_dir, kind: str) -> DataFrame:
    folder = working_path(spark, f"xml-{kind}")
    feed.write_vehicle_xml(table(spark, sf_dir, "events"), kind, folder)
    return read_vehicle_xml(spark, folder, kind)


@query("fcd_xml_ingest")
def fcd_xml_ingest(spark, sf_dir):
    return rounded(ingested_xml(spark, sf_dir, "fcd"))


@query("emission_xml_ingest")
def emission_xml_ingest(spark, sf_dir):
    return rounded(ingested_xml(spark, sf_dir, "emission"))


@query("malformed_timesteps")
def malformed_vehicle_steps(spark, sf_dir):
    """Bad timesteps by kind, with the vehicles in their texts."""
    folder = working_path(spark, "broken-xml")
    feed.write_broken_xml(table(spark, sf_dir, "events"), folder)
    bad = malformed_timesteps(spark, folder, "fcd")
    return bad.groupBy("kind").agg(
        F.count(F.lit(1)).alias("timesteps"),
        F.sum(F.regexp_count("text", F.lit('<vehicle id="v'))).alias("vehicles"),
        F.count_if(F.col("block_bytes") > 0).alias("placed"))


@query("timestep_counts")
def timestep_counts(spark, sf_dir):
    return rows_per(ingested_xml(spark, sf_dir, "fcd"), "timestep")


@query("record_total")
def record_total(spark, sf_dir):
    return count_rows(ingested_xml(spark, sf_dir, "emission"))


@query("json_decode_route")
def json_decode_route(spark, sf_dir):
    records = feed.records(table(spark, sf_dir, "events"))
    return rounded(decode_records(records, EMISSIONS_TOPIC, "emission"))


@query("route_topics")
def route_topics(spark, sf_dir):
    records = feed.records(table(spark, sf_dir, "events"))
    return rows_per(route_topic(records, FCD_TOPIC), "topic", "key")


@query("publish_records")
def publish_records(spark, sf_dir):
    records = event_records(feed.fcd_events(table(spark, sf_dir, "events")), FCD_TOPIC)

    def field(name: str, kind: str) -> Column:
        return F.get_json_object("value", f"$.{name}").cast(kind).alias(name)

    return rounded(records.select(
        "key", "topic", field("timestamp", "long"), field("vehicleId", "string"),
        field("x", "double"), field("y", "double"), field("slope", "double"),
        field("lane", "string"), F.instr("value", '"slope":').cast("boolean").alias("has_slope")))


def broken_records(spark, sf_dir) -> DataFrame:
    """Position records of which some are cut off, incomplete or null."""
    events = table(spark, sf_dir, "events")
    made = feed.fcd_events(events, "event_id")
    eid = F.col("event_id")
    lacking = made.withColumn("x", F.when(eid % 7 != 0, F.col("x")))
    value = F.to_json(F.struct(*FCD_EVENT.fieldNames()))
    damaged = F.when(eid % 29 == 0, F.lit(None).cast("string")).when(
        eid % 13 == 0, F.substring(value, 1, 20)).otherwise(value)
    return lacking.select(
        F.col("key"), damaged.alias("value"), F.lit(FCD_TOPIC).alias("topic"))


@query("required_fields")
def required_event_fields(spark, sf_dir):
    return rounded(positions_from_records(broken_records(spark, sf_dir)).withColumn(
        "event_time", F.unix_millis("event_time")))


@query("malformed_records")
def malformed_records(spark, sf_dir):
    return malformed_counts(decode_records(broken_records(spark, sf_dir), FCD_TOPIC, "fcd"))


# --- places ----------------------------------------------------------------

def identified_positions(spark, sf_dir) -> DataFrame:
    made = feed.fcd_events(table(spark, sf_dir, "events"), "event_id")
    return made.select("event_id", F.col("y").alias("vehicle_lat"), F.col("x").alias("vehicle_lon"))


@query("haversine_pairs")
def haversine_pairs(spark, sf_dir):
    """Each event's distance from one place."""
    idx = (F.col("event_id") % len(PLACES)).cast("int")
    lat = F.get(F.array(*(F.lit(p[1]) for p in PLACES)), idx)
    lon = F.get(F.array(*(F.lit(p[2]) for p in PLACES)), idx)
    distance = haversine_m(F.col("vehicle_lat"), F.col("vehicle_lon"), lat, lon)
    return identified_positions(spark, sf_dir).select(
        "event_id", F.round(distance, 4).alias("distance_m"))


@query("radius_join")
def radius_join_places(spark, sf_dir):
    joined = radius_join(identified_positions(spark, sf_dir), places_table(spark))
    return joined.select("event_id", "name", F.round("distance_m", 4).alias("distance_m"))


@query("radius_join_grid")
def radius_join_many_places(spark, sf_dir):
    """A dimension that grows with the data: a place per customer."""
    key = F.col("c_custkey")
    places = table(spark, sf_dir, "customer").select(
        key,
        (F.lit(43.30) + (key * 37 % 1000).cast("double") * F.lit(0.00005)).alias("location_lat"),
        (F.lit(21.85) + (key * 91 % 1000).cast("double") * F.lit(0.0001)).alias("location_lon"))
    joined = radius_join(
        identified_positions(spark, sf_dir), places, salt=F.col("event_id"), salts=4)
    distance = rounded_half_up(F.col("distance_m"), 4)
    return joined.select("event_id", "c_custkey", distance.alias("distance_m"))


# --- analyses --------------------------------------------------------------

@query("traffic_tumbling")
def traffic_tumbling(spark, sf_dir):
    return shown(traffic(feed.positions(spark, sf_dir)))


@query("traffic_sliding")
def traffic_sliding(spark, sf_dir):
    return shown(traffic(feed.positions(spark, sf_dir), SLIDING))


@query("traffic_approx")
def traffic_approx(spark, sf_dir):
    """Whether the sketch is within 2, or 15 percent, of the exact count."""
    keys = ["window_start", "window_end", "location_x", "location_y"]
    exact = traffic(feed.positions(spark, sf_dir))
    near = traffic(feed.positions(spark, sf_dir), mode="approx").withColumnRenamed(
        "distinct_cars_count", "approx_count")
    off = F.abs(F.col("approx_count") - F.col("distinct_cars_count"))
    close = off <= F.greatest(F.lit(2.0), F.col("distinct_cars_count") * 0.15)
    return shown(exact.join(near, keys).select(*keys, close.alias("close_to_exact")))


@query("traffic_sketch_windows")
def traffic_sketch_windows(spark, sf_dir):
    """Sliding windows merged out of stored panes, beside the exact counts."""
    path = working_path(spark, "vehicle-sketches")
    distinct_sketches(feed.positions(spark, sf_dir)).write.parquet(path)
    merged = merged_distinct(spark.read.parquet(path), SLIDING)
    keys = ["window_start", "window_end", "location_x", "location_y"]
    met = traffic(feed.positions(spark, sf_dir), SLIDING).join(merged, keys)
    off = F.abs(F.col("distinct_cars_estimate") - F.col("distinct_cars_count"))
    close = off <= F.greatest(F.lit(1.0), F.col("distinct_cars_count") * 0.05)
    return shown(met.withColumn("sketch_close", close).drop("distinct_cars_estimate"))


@query("traffic_sketch_days")
def traffic_sketch_days(spark, sf_dir):
    """Distinct vehicles per place and day out of the same panes: events are read once."""
    path = working_path(spark, "vehicle-sketches")
    positions = feed.positions(spark, sf_dir)
    distinct_sketches(positions).write.parquet(path)
    merged = merged_distinct(spark.read.parquet(path), period=F.to_date("pane_start"))
    exact = traffic(positions, WindowSpec("tumbling", "1 day")).select(
        F.to_date("window_start").alias("period"), "location_x", "location_y",
        "distinct_cars_count")
    off = F.abs(F.col("distinct_cars_estimate") - F.col("distinct_cars_count"))
    close = off <= F.greatest(F.lit(1.0), F.col("distinct_cars_count") * 0.05)
    return merged.join(exact, ["period", "location_x", "location_y"]).select(
        F.col("period").cast("string").alias("period"), "location_x", "location_y",
        "distinct_cars_count", close.alias("sketch_close"))


@query("pollution_tumbling")
def pollution_tumbling(spark, sf_dir):
    return shown(pollution(feed.emissions(spark, sf_dir)))


@query("pollution_sliding")
def pollution_sliding(spark, sf_dir):
    return shown(pollution(feed.emissions(spark, sf_dir), SLIDING))


@query("pollution_null_as_zero")
def pollution_null_as_zero(spark, sf_dir):
    return shown(pollution(feed.emissions(spark, sf_dir), null_policy="as_zero"))


def all_messages(spark, sf_dir) -> DataFrame:
    records = feed.records(table(spark, sf_dir, "events"))
    return analyse_records(records, ["traffic", "pollution"])


@query("result_messages")
def result_message_fields(spark, sf_dir):
    return rounded_results(parse_messages(all_messages(spark, sf_dir)))


@query("result_message_keys")
def result_message_keys(spark, sf_dir):
    return all_messages(spark, sf_dir).select("key")


# --- streams ---------------------------------------------------------------

def _streamed(spark, sf_dir, names: list[str], spec: WindowSpec = WindowSpec()) -> DataFrame:
    """Run the analyses as streams over the events file and read their sinks."""
    job = f"lanewatch/job-{uuid.uuid4().hex}"
    out = working_path(spark, "results")
    started = start_analyses(
        spark,
        lambda topic: feed.topic_records(feed.table_stream(spark, sf_dir, "events"), topic),
        names, job, "parquet", lambda name: {"path": f"{out}/{name}"}, spec,
        available_now=True, state_partitions=spark.sparkContext.defaultParallelism)
    for stream in started:
        stream.awaitTermination()
    return result_table(spark, f"{out}/{names[0]}")


@query("stream_traffic")
def stream_traffic(spark, sf_dir):
    return rounded(_streamed(spark, sf_dir, ["traffic"]).select(
        "window_start", "window_end", "location_x", "location_y", "distinct_cars_count",
        "analysis_type"))


@query("stream_traffic_sliding")
def stream_traffic_sliding(spark, sf_dir):
    return rounded(_streamed(spark, sf_dir, ["traffic"], SLIDING).select(
        "window_start", "window_end", "location_x", "location_y", "distinct_cars_count",
        "analysis_type"))


@query("stream_pollution")
def stream_pollution(spark, sf_dir):
    return rounded_results(
        _streamed(spark, sf_dir, ["pollution"]).drop("distinct_cars_count"))


@query("stream_union")
def stream_union(spark, sf_dir):
    out = working_path(spark, "results")
    records = feed.records(feed.table_stream(spark, sf_dir, "events"))
    start_union(
        spark, records, ["traffic", "pollution"], f"lanewatch/job-{uuid.uuid4().hex}",
        "parquet", {"path": out}, available_now=True,
        state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return rounded_results(result_table(spark, out))


# --- map features ----------------------------------------------------------

def results(spark, sf_dir) -> DataFrame:
    """Results of both analyses, and damaged copies that no feature may use."""
    good = parse_messages(all_messages(spark, sf_dir))
    minute = F.substring("window_start", 15, 2).cast("int") % 3
    copies = good.filter(F.col("analysis_type") == "traffic").withColumns({
        "location_x": F.when(minute != 0, F.col("location_x")),
        "analysis_type": F.when(minute == 1, "speed").otherwise(F.col("analysis_type")),
        "window_start": F.when(minute == 2, "").otherwise(F.col("window_start")),
    })
    return good.unionByName(copies)


@query("usable_results")
def usable_result_rows(spark, sf_dir):
    return rounded(usable_results(results(spark, sf_dir)).select(
        "window_start", "location_x", "location_y", "distinct_cars_count", "avg_co2",
        "analysis_type"), 9)


@query("scale_bounds")
def colour_scale_bounds(spark, sf_dir):
    return rounded(scale_bounds(usable_results(results(spark, sf_dir))))


@query("map_centre")
def map_centre_point(spark, sf_dir):
    return rounded(map_centre(usable_results(results(spark, sf_dir))))


@query("place_names")
def place_names(spark, sf_dir):
    """Names of places; every other minute lies a little off and has none."""
    moved = F.round(F.col("location_x") + F.lit(0.001), 6)
    odd = F.substring("window_start", 15, 2).cast("int") % 2 == 1
    shifted = usable_results(results(spark, sf_dir)).withColumn(
        "location_x", F.when(odd, moved).otherwise(F.col("location_x")))
    named = with_place_name(shifted, places_table(spark))
    return named.groupBy("place_name").agg(F.count(F.lit(1)).alias("results"))


@query("circle_rings")
def circle_rings(spark, sf_dir):
    places = usable_results(results(spark, sf_dir)).select("location_x", "location_y").distinct()
    ring = circle_ring(F.col("location_x"), F.col("location_y"))
    points = places.select("location_x", "location_y", F.posexplode(ring).alias("i", "point"))
    return rounded(points.select(
        "location_x", "location_y", "i", F.col("point")[0].alias("lon"),
        F.col("point")[1].alias("lat")), 9)


@query("feature_colours")
def feature_colours(spark, sf_dir):
    return with_colours(usable_results(results(spark, sf_dir))).select(
        "analysis_type", "window_start", "location_x", "location_y", "colour")


@query("feature_labels")
def feature_labels(spark, sf_dir):
    labelled = with_labels(usable_results(results(spark, sf_dir)))
    return labelled.select(
        "place_name", "window_start", "window_end", "location_x", "location_y",
        *(c for c in labelled.columns if c.startswith("label_")))


@query("features")
def map_features(spark, sf_dir):
    made = features(usable_results(results(spark, sf_dir)))

    def part(path: str) -> Column:
        return F.get_json_object("feature", path)

    return made.select(
        "analysis_type", "time", "location_x", "location_y", "place_name", "colour",
        part("$.geometry.type").alias("shape"),
        (F.size(F.split(part("$.geometry.coordinates[0]"), "\\],\\["))).alias("ring_points"),
        part("$.properties.time").alias("feature_time"),
        part("$.properties.style.fillColor").alias("fill"),
        part("$.properties.style.weight").cast("int").alias("weight"),
        part("$.properties.style.fillOpacity").cast("double").alias("fill_opacity"))


@query("feature_frames")
def feature_frames(spark, sf_dir):
    """The frames' documents, written, read whole and parsed."""
    path = working_path(spark, "frames")
    write_frame_collections(features(usable_results(results(spark, sf_dir))), path)
    documents = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "type string, features array<struct<type string,"
                         "properties struct<time string>>>", {"mode": "FAILFAST"})
    time = iso_instant(F.col("at"))
    return documents.select(
        F.col("frame").cast("timestamp").alias("at"), parsed.alias("document")).select(
        time.alias("frame"), F.col("document.type").alias("type"),
        F.size("document.features").cast("long").alias("features"),
        F.forall("document.features", lambda f: (f["type"] == "Feature") & (
            f["properties"]["time"] == time)).alias("sound"))
