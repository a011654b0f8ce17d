"""Joins on position: events within a radius of places, and place names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lanewatch.functions.geo import (
    cell_in_band, cells_in_band, haversine_m, latitude_band, latitude_cosine, within_m,
)
from lanewatch.places import RADIUS_M


# Latitude band and cell number share one 64-bit join key.
_CELL_BITS = 32
_SMALLEST_RADIUS_M = 0.1
_TASKS_PER_CORE = 8


def _with_cell(df: DataFrame, lon: str, radius_m: float) -> DataFrame:
    """Add ``_cells``, the number of cells in ``_band``, and ``_cell``, the row's own.

    Each step is a column of its own, so that no expression is written twice.
    """
    counted = df.withColumn("_cells", cells_in_band(F.col("_band"), radius_m))
    return counted.withColumn("_cell", cell_in_band(F.col(lon), F.col("_cells")))


def _cell_key(band: Column, cell: Column) -> Column:
    # Never null, so that the join adds no null test of the whole expression.
    return F.coalesce(F.shiftleft(band, _CELL_BITS) + cell, F.lit(0).cast("long"))


def _on_earth(lat: str, lon: str) -> Column:
    """Positions with a latitude and a finite longitude; others can match nothing."""
    return (F.abs(F.col(lat)) <= 90) & (F.abs(F.col(lon)) < float("inf"))


def _event_cells(events: DataFrame, lat: str, lon: str, radius_m: float) -> DataFrame:
    banded = events.filter(_on_earth(lat, lon)).withColumn(
        "_band", latitude_band(F.col(lat), radius_m))
    own = _with_cell(banded, lon, radius_m)
    return own.withColumn("_key", _cell_key(F.col("_band"), F.col("_cell"))).drop(
        "_band", "_cells", "_cell")


def _place_cells(places: DataFrame, radius_m: float) -> DataFrame:
    """Each place once per cell in which an event could lie within the radius."""
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    middle = latitude_band(F.col("location_lat"), radius_m)
    known = places.filter(_on_earth("location_lat", "location_lon"))
    banded = known.withColumn("_band", F.explode(F.transform(steps, lambda d: middle + d)))
    own = _with_cell(banded, "location_lon", radius_m)
    around = F.array_distinct(F.transform(
        steps, lambda d: F.pmod(F.col("_cell") + d, F.col("_cells"))))
    return own.withColumn("_cell", F.explode(around)).withColumn(
        "_key", _cell_key(F.col("_band"), F.col("_cell"))).drop("_band", "_cells", "_cell")


def _join_tasks(spark: SparkSession) -> int:
    """Tasks for a join whose work is its pairs, which the size of its input does not tell."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               _TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def radius_join(
    events: DataFrame,
    places: DataFrame,
    radius_m: float = RADIUS_M,
    lat: str = "vehicle_lat",
    lon: str = "vehicle_lon",
    salt: Column | None = None,
    salts: int = 1,
    large: bool = False,
) -> DataFrame:
    """Pairs of events and places no further apart than the radius, inclusive.

    An event near several places leaves once for each.  ``places`` has
    location_lat and location_lon; its other columns come along, and
    ``distance_m`` is added.

    This is an equi-join on grid cells followed by the distance test, right
    everywhere on the sphere.  Places within the session's broadcast limit are
    broadcast on their known size, and events are not shuffled at all.  Spark
    counts a place once, though it leaves for nine cells and each salt, and
    takes a table for its size in the file; so a dimension that grows is to be
    called ``large``, as one with salts always is.  It is joined by shuffle and
    never held by the driver; adaptive execution then splits a crowded cell in
    batch.  For streams, which it does not reach, or where a cell's pairs are
    many though its rows are not, give a ``salt`` spread over the events and a
    number of ``salts``: each place is repeated per salt and a crowded cell is
    cut into that many parts.  In batch these are dealt to a fixed number of
    tasks, as adaptive execution would merge them by the size of their rows.
    """
    if radius_m < _SMALLEST_RADIUS_M:
        raise ValueError(f"the radius must be at least {_SMALLEST_RADIUS_M} m")
    spread_out = salts > 1 and not events.isStreaming
    if spread_out:  # a small file of places is one task, which would make all their copies
        places = places.repartition(places.sparkSession.sparkContext.defaultParallelism)
    placed = _event_cells(events, lat, lon, radius_m)
    near = _place_cells(places, radius_m)
    on = ["_key"]
    if salts > 1:
        spread = salt if salt is not None else F.xxhash64(*(F.col(f"`{c}`") for c in events.columns))
        placed = placed.withColumn("_salt", F.pmod(F.hash(spread), F.lit(salts)))
        near = near.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on.append("_salt")
    if large or salts > 1:
        near = near.hint("merge")
    if spread_out:
        parts = _join_tasks(events.sparkSession)
        placed, near = placed.repartition(parts, *on), near.repartition(parts, *on)
    # Cosines are taken once a row, the distance only of what is kept.
    cosines = ["_event_cos", "_place_cos"]
    placed = placed.withColumn("_event_cos", latitude_cosine(F.col(lat)))
    near = near.withColumn("_place_cos", latitude_cosine(F.col("location_lat")))
    pair = [F.col(c) for c in (lat, lon, "location_lat", "location_lon", *cosines)]
    return (
        placed.join(near, on)
        .filter(within_m(*pair, radius_m))
        .withColumn("distance_m", haversine_m(*pair))
        .drop(*on, *cosines)
    )


def with_place_name(
    df: DataFrame, places: DataFrame, lat: str = "location_x", lon: str = "location_y"
) -> DataFrame:
    """Add ``place_name``: the place at the same six-decimal position.

    Where there is none the position itself is written, ``"lat, lon"``; of several
    places at one position the first name in text order counts.
    """
    names = places.groupBy(
        F.round("location_lat", 6).alias("_lat6"),
        F.round("location_lon", 6).alias("_lon6"),
    ).agg(F.min("name").alias("_name"))
    keyed = df.withColumns({
        "_lat6": F.round(F.col(lat), 6), "_lon6": F.round(F.col(lon), 6),
    })
    fallback = F.concat(F.col(lat).cast("string"), F.lit(", "), F.col(lon).cast("string"))
    return (
        keyed.join(names, ["_lat6", "_lon6"], "left")
        .withColumn("place_name", F.coalesce("_name", fallback))
        .drop("_lat6", "_lon6", "_name")
    )
