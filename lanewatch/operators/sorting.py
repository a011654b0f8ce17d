"""Global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from lanewatch.functions.values import nan_to_null


def parse_sort_terms(terms: str) -> list[tuple[str, bool]]:
    """``"a.1,b.0"`` to ``[("a", True), ("b", False)]``; only 1 means ascending."""
    parsed = []
    for term in terms.split(","):
        pieces = term.split(".")
        if len(pieces) != 2:
            raise ValueError(f"sort term {term!r} is not of the form column.1 or column.0")
        parsed.append((pieces[0], pieces[1] == "1"))
    return parsed


def sort_terms(df: DataFrame, terms: str | None) -> DataFrame:
    """Total order over ``"a.1,b.0"``, missing values last in either direction.

    Rows that tie are ordered further by a hash of their content and by the
    partition they come from.  That changes no asked-for order, but it lets
    the range exchange cut a value, or a row's copies, that fills many
    partitions, which it could not do on the sort keys alone.  A task that is run
    again gives its rows the same partition number.
    """
    if not terms:
        return df
    order = []
    for column, ascending in parse_sort_terms(terms):
        if column not in df.columns:
            raise ValueError(f"unknown column {column!r}")
        key = F.col(column)
        if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
            key = nan_to_null(key)
        order.append(key.asc_nulls_last() if ascending else key.desc_nulls_last())
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = df.withColumns({
        "_content": F.xxhash64(*(F.col(f"`{c}`") for c in hashable)),
        "_from": F.spark_partition_id(),
    })
    return spread.orderBy(*order, "_content", "_from").drop("_content", "_from")
