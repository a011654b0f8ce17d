"""Sketches that are stored once and merged later, without reading the rows again.

Distinct counts are HyperLogLog sketches per place and pane of time; they merge to windows,
hours or days.  Quantiles are KLL sketches per group; they merge over any parts, and an answer
is checked by counting rows on both sides of it.  A sketch has a bounded size, so no task holds
a group's values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lanewatch.plans.analyses import match_to_places
from lanewatch.streaming.windows import WindowSpec

#: Log 2 of the registers; the relative standard error is about 1.04 / sqrt(2 ** LG_K).
LG_K = 12
#: Size of a quantile sketch, and the rank error that it stays within with 99 % probability.
KLL_K, KLL_RANK_ERROR = 200, 0.0165

PLACE = ("location_x", "location_y")


def distinct_sketches(positions: DataFrame, pane: str = "10 seconds",
                      places: DataFrame | None = None, lg_k: int = LG_K) -> DataFrame:
    """``(pane_start, pane_end, location_x, location_y, vehicles)``: a sketch per pane and place.

    ``vehicles`` is binary and meant to be stored.  Events without a vehicle id leave the
    sketch as it is.
    """
    matched = match_to_places(positions, places, WindowSpec("tumbling", pane))
    sketched = matched.groupBy(
        F.window("event_time", pane).alias("pane"), "location_lat", "location_lon").agg(
        F.hll_sketch_agg("vehicle_id", F.lit(lg_k)).alias("vehicles"))
    return sketched.select(
        F.col("pane.start").alias("pane_start"), F.col("pane.end").alias("pane_end"),
        F.col("location_lat").alias("location_x"), F.col("location_lon").alias("location_y"),
        "vehicles")


def merged_distinct(sketches: DataFrame, spec: WindowSpec | None = None,
                    period: Column | None = None) -> DataFrame:
    """Estimated distinct vehicles per place and window, or per ``period``, out of stored panes.

    A window must be made of whole panes; one that cuts a pane is an error.  ``period`` is any
    expression of ``pane_start``, such as its day.
    """
    estimate = F.hll_sketch_estimate(F.hll_union_agg("vehicles")).alias("distinct_cars_estimate")
    if period is not None:
        return sketches.groupBy(period.alias("period"), *PLACE).agg(estimate)
    windowed = sketches.withColumn("window", (spec or WindowSpec()).column("pane_start"))
    whole = F.assert_true(
        F.col("pane_end") <= F.col("window.end"), F.lit("a window ends within a pane"))
    merged = windowed.where(whole.isNull()).groupBy("window", *PLACE).agg(estimate)
    return merged.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *PLACE, "distinct_cars_estimate")


def quantile_sketches(rows: DataFrame, keys: list[str], column: str, k: int = KLL_K) -> DataFrame:
    """``(*keys, sketch)``: a sketch of a numeric column per group, nulls and NaN left out."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    return rows.where(value.isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"))


def merged_quantile(sketches: DataFrame, keys: list[str], rank: float, k: int = KLL_K) -> DataFrame:
    """``(*keys, values, quantile)``: the value at a rank from 0 to 1, and how many were sketched."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return merged.select(
        *keys, F.kll_sketch_get_n_double("sketch").alias("values"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(rank)).alias("quantile"))


def rank_errors(rows: DataFrame, answers: DataFrame, keys: list[str], column: str,
                rank: float, answer: str = "quantile") -> DataFrame:
    """``(*keys, rows, rank_error)``: how far each answer's true rank lies from the asked one.

    One aggregate counts the rows below and up to the answer; equal rows make a span of ranks,
    whose distance to ``rank`` is the error.  Groups of any size are counted in parts.
    """
    value = F.col(column).cast("double")
    held = rows.where(value.isNotNull() & ~F.isnan(value)).select(*keys, value.alias("_value"))
    met = held.join(answers.select(*keys, F.col(answer).alias("_answer")), keys)
    counted = met.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_value") < F.col("_answer")).alias("below"),
        F.count_if(F.col("_value") <= F.col("_answer")).alias("up_to"))
    low, high = F.col("below") / F.col("rows"), F.col("up_to") / F.col("rows")
    error = F.greatest(F.lit(0.0), low - F.lit(rank), F.lit(rank) - high)
    return counted.select(*keys, "rows", error.alias("rank_error"))
