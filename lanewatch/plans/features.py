"""Result rows to time-stamped, coloured map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lanewatch.functions.colours import (
    POLLUTION_SCALE, TRAFFIC_SCALE, colour_at, scale_position,
)
from lanewatch.functions.geo import circle_ring
from lanewatch.functions.values import fixed_digits
from lanewatch.operators.matching import with_place_name
from lanewatch.places import RADIUS_M, places_table

# Outline and fill per kind, label digits per pollutant, and the
# length of one frame of the timeline.
STYLES = {
    "traffic": {"weight": 5, "fillOpacity": 0.08, "opacity": 0.95},
    "pollution": {"weight": 1, "fillOpacity": 0.35, "opacity": 0.6},
}
LABEL_DIGITS = {"co2": 2, "co": 2, "hc": 4, "nox": 4, "pmx": 4, "noise": 2}
FRAME_PERIOD = "PT1M"


def _is(kind: str) -> Column:
    return F.col("analysis_type") == kind


def usable_results(results: DataFrame) -> DataFrame:
    """Rows of a known kind with a start and both coordinates."""
    return results.filter(
        F.col("analysis_type").isin("traffic", "pollution")
        & (F.col("window_start").cast("string") != "")
        & F.col("location_x").isNotNull()
        & F.col("location_y").isNotNull()
    )


def require_usable(results: DataFrame) -> DataFrame:
    """:func:`usable_results`, or ValueError if there are none (one short job)."""
    usable = usable_results(results)
    if usable.isEmpty():
        raise ValueError("no usable traffic or pollution results")
    return usable


def _bounds(value: Column, prefix: str) -> list[Column]:
    low, high = F.min(value).cast("double"), F.max(value).cast("double")
    top = F.when(low.isNull(), 1.0).when(low == high, low + 1).otherwise(high)
    return [
        F.coalesce(low, F.lit(0.0)).alias(f"{prefix}_low"), top.alias(f"{prefix}_high"),
    ]


def scale_bounds(usable: DataFrame) -> DataFrame:
    """One row: ends of the traffic and the pollution colour scale.

    Nulls are left out; no value at all gives 0 and 1, a single value v gives
    v and v + 1.
    """
    return usable.agg(
        *_bounds(F.when(_is("traffic"), F.col("distinct_cars_count")), "traffic"),
        *_bounds(F.when(_is("pollution"), F.col("avg_co2")), "pollution"),
    )


def map_centre(usable: DataFrame) -> DataFrame:
    """One row: mean latitude and longitude of the usable rows."""
    return usable.agg(
        F.avg("location_x").alias("centre_lat"), F.avg("location_y").alias("centre_lon")
    )


def with_colours(usable: DataFrame) -> DataFrame:
    """Add ``colour``: traffic by vehicle count, pollution by mean CO2.

    The scale ends come from one aggregate over the same rows, used as a scalar
    subquery: they reach every task as constants.
    """
    bounds = scale_bounds(usable)
    ends = bounds.select(F.struct(*bounds.columns)).scalar()
    traffic_at = scale_position(
        F.col("distinct_cars_count"), F.col("_ends.traffic_low"), F.col("_ends.traffic_high"))
    pollution_at = scale_position(
        F.col("avg_co2"), F.col("_ends.pollution_low"), F.col("_ends.pollution_high"))
    placed = usable.withColumn("_ends", ends).withColumn(
        "_at", F.when(_is("traffic"), traffic_at).otherwise(pollution_at))
    return placed.withColumn(
        "colour",
        F.when(_is("traffic"), colour_at(F.col("_at"), TRAFFIC_SCALE))
        .otherwise(colour_at(F.col("_at"), POLLUTION_SCALE)),
    ).drop("_ends", "_at")


def label_fields() -> list[Column]:
    """Texts of a feature's label; those of the other kind are null."""
    columns = [
        F.when(_is("traffic"), F.col("distinct_cars_count").cast("string"))
        .alias("label_distinct_cars")
    ]
    for part in ("avg", "max"):
        for name, digits in LABEL_DIGITS.items():
            text = fixed_digits(F.col(f"{part}_{name}"), digits)
            if name == "noise":
                text = F.concat(text, F.lit(" dB"))
            columns.append(F.when(_is("pollution"), text).alias(f"label_{part}_{name}"))
    return columns


def with_labels(usable: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Add the place name, the kind as a title and the label texts."""
    table = places if places is not None else places_table(usable.sparkSession)
    named = with_place_name(usable, table)
    return named.select("*", F.initcap("analysis_type").alias("label_kind"), *label_fields())


def _style(colour: Column) -> Column:
    def value(name: str) -> Column:
        return F.when(_is("traffic"), F.lit(STYLES["traffic"][name])).otherwise(
            F.lit(STYLES["pollution"][name]))

    return F.struct(
        colour.alias("color"), value("weight").alias("weight"), colour.alias("fillColor"),
        value("fillOpacity").alias("fillOpacity"), value("opacity").alias("opacity"),
    )


def features(
    usable: DataFrame, places: DataFrame | None = None, radius_m: float = RADIUS_M
) -> DataFrame:
    """One row per usable result: time, colour, label texts and the GeoJSON feature.

    ``time`` is the window's start; a frame lasts :data:`FRAME_PERIOD`.
    """
    rows = with_labels(with_colours(usable), places)
    labels = [c for c in rows.columns if c.startswith("label_")]
    ring = circle_ring(F.col("location_x"), F.col("location_y"), radius_m)
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
        .alias("geometry"),
        F.struct(
            F.col("window_start").alias("time"),
            F.struct("place_name", "window_start", "window_end", *labels,
                     "location_x", "location_y").alias("label"),
            _style(F.col("colour")).alias("style"),
        ).alias("properties"),
    )
    return rows.select(
        "analysis_type", F.col("window_start").alias("time"), "location_x", "location_y",
        "place_name", "colour", *labels, F.to_json(feature).alias("feature"),
    )
