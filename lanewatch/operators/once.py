"""Keeping costly expressions from being evaluated again and again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, columns: dict[str, Column], keep: str | list[str] = "*") -> DataFrame:
    """Add columns whose expressions later steps do not repeat.

    A filter on a computed column is normally pushed below its computation
    with the expression written out in it, once per use.  For parsing, or for
    offsets that many columns build on, that multiplies the work.  Columns out
    of a one-element ``inline`` are left where they are.
    """
    kept = [keep] if isinstance(keep, str) else keep
    row = F.struct(*(expr.alias(name) for name, expr in columns.items()))
    return df.select(*kept, F.inline(F.array(row)))
