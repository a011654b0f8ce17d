"""Result rows to keyed JSON messages and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lanewatch.functions.times import iso_instant
from lanewatch.operators.once import computed_once
from lanewatch.schemas import ANY_RESULT


def result_messages(results: DataFrame, name: str) -> DataFrame:
    """(key, value): key ``name/start/end/lat/lon``, value JSON with explicit nulls."""
    start, end = iso_instant(F.col("window_start")), iso_instant(F.col("window_end"))
    key = F.concat_ws(
        "/", F.lit(name), start, end,
        F.col("location_x").cast("string"), F.col("location_y").cast("string"),
    )
    fields = {c: F.col(c) for c in results.columns} | {"window_start": start, "window_end": end}
    value = F.to_json(
        F.struct(*(expr.alias(c) for c, expr in fields.items())), {"ignoreNullFields": "false"}
    )
    return results.select(key.alias("key"), value.alias("value"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message values as result rows of either analysis; absent fields are null."""
    parsed = F.from_json(F.col("value").cast("string"), ANY_RESULT)
    return computed_once(messages, {"data": parsed}, keep=[]).select("data.*")
