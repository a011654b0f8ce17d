"""The traffic and pollution analyses, and the registry they are chosen from."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lanewatch.operators.matching import radius_join
from lanewatch.places import EMISSIONS_TOPIC, FCD_TOPIC, RADIUS_M, places_table
from lanewatch.plans.events import emissions_from_records, positions_from_records
from lanewatch.plans.messages import result_messages
from lanewatch.schemas import POLLUTANTS
from lanewatch.streaming.windows import WindowSpec

KEYS = ("window", "location_lat", "location_lon")


def match_to_places(
    events: DataFrame, places: DataFrame | None, spec: WindowSpec, salts: int = 1
) -> DataFrame:
    """Watermarked events with the places they are near; one row per pair."""
    table = places if places is not None else places_table(events.sparkSession)
    return radius_join(
        events.withWatermark("event_time", spec.delay),
        table.select("location_lat", "location_lon"),
        RADIUS_M,
        salt=F.col("vehicle_id"),
        salts=salts,
    )


def _result_frame(aggregated: DataFrame, name: str, measures: Iterable[str]) -> DataFrame:
    return aggregated.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("location_lat").alias("location_x"),
        F.col("location_lon").alias("location_y"),
        *measures,
        F.lit(name).alias("analysis_type"),
    )


def _sliding_distinct(matched: DataFrame, pane: str, micros: int, reach: int) -> DataFrame:
    """Exact distinct vehicles per sliding window, by counting differences.

    A vehicle seen in pane p is in the ``reach`` windows that begin at p - reach + 1 to p.
    Panes at most ``reach`` apart open one run of windows without a gap, so a vehicle adds one
    where a run begins and takes one off behind its end.  Running sums of these differences
    are the counts; rows are repeated only as results, never as sightings.  A vehicle without
    an id keeps its windows, and counts for nothing.
    """
    at = F.floor(F.unix_micros(F.window("event_time", pane)["start"]) / F.lit(micros))
    place = ["location_lat", "location_lon"]
    seen = matched.groupBy(*place, "vehicle_id", at.alias("pane")).agg(
        F.count(F.lit(1)).alias("sightings"))
    in_order = Window.partitionBy(*place, "vehicle_id").orderBy("pane")
    runs = seen.select(
        *place, "vehicle_id", "pane", F.lag("pane").over(in_order).alias("earlier"),
        F.lead("pane").over(in_order).alias("later"))
    begins = F.when(
        F.col("earlier").isNull() | (F.col("pane") - F.col("earlier") > reach),
        F.struct((F.col("pane") - (reach - 1)).alias("first"), F.lit(1).alias("step")))
    ends = F.when(
        F.col("later").isNull() | (F.col("later") - F.col("pane") > reach),
        F.struct((F.col("pane") + 1).alias("first"), F.lit(-1).alias("step")))
    steps = runs.select(
        *place, F.col("vehicle_id").isNotNull().cast("int").alias("known"),
        F.inline(F.array_compact(F.array(begins, ends))))
    changes = steps.groupBy(*place, "first").agg(
        F.sum("step").alias("open"), F.sum(F.col("step") * F.col("known")).alias("cars"))
    along = Window.partitionBy(*place).orderBy("first")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    held = changes.select(
        *place, "first", F.sum("open").over(so_far).alias("open"),
        F.sum("cars").over(so_far).alias("distinct_cars_count"),
        F.lead("first").over(along).alias("next"))
    counted = held.where("open > 0").select(
        *place, "distinct_cars_count",
        F.explode(F.sequence(F.col("first"), F.col("next") - 1)).alias("first"))
    start = F.col("first") * F.lit(micros)
    return counted.select(
        F.struct(F.timestamp_micros(start).alias("start"),
                 F.timestamp_micros(start + F.lit(micros * reach)).alias("end")).alias("window"),
        *place, "distinct_cars_count")


def traffic(
    positions: DataFrame,
    spec: WindowSpec = WindowSpec(),
    places: DataFrame | None = None,
    mode: str = "exact",
    salts: int = 1,
) -> DataFrame:
    """Distinct vehicles per window and place.

    ``exact`` first groups by window, place and vehicle, then counts the groups.
    Repeated sightings collapse before the first shuffle, and that shuffle
    spreads by vehicle: neither a crowded place nor one chatty vehicle ends up
    in one task, and a stream's state is one small entry per vehicle instead
    of a growing set per place.  ``approx`` keeps one fixed-size sketch per
    window and place.  Sliding windows made of whole slides are counted by
    differences in batch, without repeating sightings for the windows they are in.
    ``salts`` is for place tables too large to broadcast; see ``radius_join``.
    """
    window = spec.column()
    matched = match_to_places(positions, places, spec, salts)
    panes = None if matched.isStreaming else spec.panes()
    if mode == "exact" and panes:
        return _result_frame(
            _sliding_distinct(matched, spec.pane(), *panes), "traffic", ["distinct_cars_count"])
    matched = matched.withColumn("window", window)
    if mode == "exact":
        seen = matched.groupBy(*KEYS, "vehicle_id").agg(F.count(F.lit(1)).alias("sightings"))
        counted = seen.groupBy(*KEYS).agg(F.count("vehicle_id").alias("distinct_cars_count"))
    elif mode == "approx":
        counted = matched.groupBy(*KEYS).agg(
            F.approx_count_distinct("vehicle_id").alias("distinct_cars_count"))
    else:
        raise ValueError(f"unknown distinct mode {mode!r}")
    return _result_frame(counted, "traffic", ["distinct_cars_count"])


def pollution(
    emissions: DataFrame,
    spec: WindowSpec = WindowSpec(),
    places: DataFrame | None = None,
    null_policy: str = "skip",
    salts: int = 1,
) -> DataFrame:
    """Mean and greatest value of six pollutants per window and place.

    ``null_policy="as_zero"`` divides the sum by all rows instead of by the
    rows that have a value, so the mean of nothing is 0.  The maximum of
    nothing is null either way.

    Sliding windows overlap, so in batch the measures are first summed up per
    slide, and only those few rows are repeated for the windows they belong to.
    A stream does without that step: it would drop rows that are late for their
    slide but not for their windows.
    """
    if null_policy not in ("skip", "as_zero"):
        raise ValueError(f"unknown null policy {null_policy!r}")
    window = spec.column()
    matched = match_to_places(emissions, places, spec, salts)
    pane = None if matched.isStreaming else spec.pane()
    if pane:
        sums = [F.sum(p).alias(f"sum_{p}") for p in POLLUTANTS]
        known = [F.count(p).alias(f"known_{p}") for p in POLLUTANTS]
        maxima = [F.max(p).alias(p) for p in POLLUTANTS]
        matched = matched.groupBy(
            F.window("event_time", pane).alias("pane"), "location_lat", "location_lon"
        ).agg(F.count(F.lit(1)).alias("rows"), *sums, *known, *maxima).withColumn(
            "event_time", F.col("pane.start"))

    def mean(name: str) -> Column:
        total = F.sum(f"sum_{name}" if pane else name)
        if null_policy == "as_zero":
            rows = F.sum("rows") if pane else F.count(F.lit(1))
            return F.coalesce(total, F.lit(0.0)) / rows
        if not pane:
            return F.avg(name)
        return total / F.nullif(F.sum(f"known_{name}"), F.lit(0).cast("long"))

    averages = [mean(p).alias(f"avg_{p}") for p in POLLUTANTS]
    maxima = [F.max(p).alias(f"max_{p}") for p in POLLUTANTS]
    measured = matched.withColumn("window", window).groupBy(*KEYS).agg(*averages, *maxima)
    names = [f"avg_{p}" for p in POLLUTANTS] + [f"max_{p}" for p in POLLUTANTS]
    return _result_frame(measured, "pollution", names)


# An analysis takes (records, topic, window settings) to a result table with
# window_start, window_end, location_x, location_y and analysis_type.
Analysis = Callable[[DataFrame, str, WindowSpec], DataFrame]

_ANALYSES: dict[str, Analysis] = {}

DEFAULT_TOPICS = {"traffic": FCD_TOPIC, "pollution": EMISSIONS_TOPIC}


def register_analysis(name: str, analysis: Analysis) -> None:
    """Make an analysis available under a name; a later one replaces it."""
    _ANALYSES[name] = analysis


register_analysis(
    "traffic", lambda records, topic, spec: traffic(positions_from_records(records, topic), spec))
register_analysis(
    "pollution",
    lambda records, topic, spec: pollution(emissions_from_records(records, topic), spec))


def active_analyses(
    names: Iterable[str], topics: dict[str, str] | None = None
) -> dict[str, tuple[Analysis, str]]:
    """The named analyses, each with the topic it reads.

    No name, an unknown name or a name without a topic is an error, raised
    before anything starts.
    """
    mapping = topics or DEFAULT_TOPICS
    wanted = list(dict.fromkeys(names))
    if not wanted:
        raise ValueError("no active analysis")
    unknown = [n for n in wanted if n not in _ANALYSES]
    if unknown:
        raise ValueError(f"unknown analyses: {', '.join(unknown)}")
    unmapped = [n for n in wanted if n not in mapping]
    if unmapped:
        raise ValueError(f"analyses without an input topic: {', '.join(unmapped)}")
    return {n: (_ANALYSES[n], mapping[n]) for n in wanted}


def union_results(results: Iterable[DataFrame]) -> DataFrame:
    """All result messages (key, value) together, duplicates kept."""
    return reduce(DataFrame.unionByName, results)


def analyse_records(
    records: DataFrame,
    names: Iterable[str],
    spec: WindowSpec = WindowSpec(),
    topics: dict[str, str] | None = None,
) -> DataFrame:
    """Messages of all named analyses over one record table or stream."""
    return union_results(
        result_messages(analysis(records, topic, spec), name)
        for name, (analysis, topic) in active_analyses(names, topics).items()
    )


def topic_mapping(text: str) -> dict[str, str]:
    """``"traffic:FCD;pollution:EMISSIONS"`` as a dict."""
    return dict(pair.split(":")[:2] for pair in text.split(";"))


def analysis_names(text: str) -> list[str]:
    """``"traffic, pollution"`` as a list."""
    return [name.strip() for name in text.split(",")]
