"""Colour scales."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# CSS colours as (red, green, blue), and the two scales.
CSS_COLOURS = {
    "blue": (0, 0, 255),
    "green": (0, 128, 0),
    "purple": (128, 0, 128),
    "red": (255, 0, 0),
    "yellow": (255, 255, 0),
}
TRAFFIC_SCALE = ("green", "yellow", "red")
POLLUTION_SCALE = ("blue", "purple", "red")


def scale_position(value: Column, low: Column, high: Column) -> Column:
    """Where a value lies on a scale, from 0 to 1.

    A null value counts as 0; values outside the scale lie at its ends.
    """
    share = (F.coalesce(value.cast("double"), F.lit(0.0)) - low) / (high - low)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def colour_at(position: Column, anchors=TRAFFIC_SCALE) -> Column:
    """``#rrggbbaa`` at a position on evenly spaced anchor colours.

    The position is used many times over: pass a plain column.
    """
    steps = len(anchors) - 1
    rgb = [CSS_COLOURS[name] for name in anchors]

    def channel(k: int) -> Column:
        level = F.lit(rgb[0][k] / 255.0)
        for i in range(steps):
            start, stop = rgb[i][k] / 255.0, rgb[i + 1][k] / 255.0
            part = position * steps - i
            level = F.when(part > 0, (1 - part) * start + part * stop).otherwise(level)
        return F.lpad(F.lower(F.hex(F.floor(level * 255.9999))), 2, "0")

    return F.concat(F.lit("#"), channel(0), channel(1), channel(2), F.lit("ff"))
