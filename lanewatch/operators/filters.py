"""Column filters: text equality, numeric comparison, conjunctions, required fields.

Each comparison is written so that the part a Parquet scan can use reaches it.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lanewatch.functions.values import number_or_null


def _kind(df: DataFrame, column: str) -> T.DataType:
    if column not in df.columns:
        raise ValueError(f"unknown column {column!r}; columns are {', '.join(df.columns)}")
    return df.schema[column].dataType


def _equals_text(c: Column, kind: T.DataType, wanted: str) -> Column:
    value = wanted.lower()
    as_text = F.lower(c.cast("string"))
    if value == "nan":
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return c.isNull() | F.isnan(c)
        return c.isNull() | (as_text == value)
    if isinstance(kind, T.IntegralType):
        # An integer prints one way only, so the test is on the number itself.
        digits = value[1:] if value.startswith("-") else value
        canonical = digits.isascii() and digits.isdigit() and str(int(value)) == value
        in_range = canonical and -(2 ** 63) <= int(value) < 2 ** 63
        return c == F.lit(int(value)) if in_range else F.lit(False)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # A number has one usual spelling, so the test is on the number itself.
        try:
            number = float(value)
        except ValueError:
            return F.lit(False)
        if isinstance(kind, T.DoubleType):
            return c == F.lit(number) if repr(number) == value else F.lit(False)
        single = np.float32(number)
        return c == F.lit(float(single)).cast("float") if str(single) == value else F.lit(False)
    if isinstance(kind, T.StringType) and value == value.upper():
        return c == F.lit(value)  # nothing in the text has a case
    return as_text == value


def where_equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column, written as text, equals ``value`` in any case.

    ``nan`` selects missing values.  Integers compare as integers even where
    the column has nulls, so ``443`` matches 443.
    """
    return df.filter(_equals_text(F.col(column), _kind(df, column), value.strip()))


def _where_compared(df: DataFrame, column: str, value: float, greater: bool) -> DataFrame:
    kind = _kind(df, column)
    bound = float(value)
    if math.isnan(bound):
        return df.filter(F.lit(False))
    coerced = number_or_null(F.col(column), kind)
    tested = coerced
    limit = F.lit(bound)
    if isinstance(kind, T.IntegralType) and abs(bound) < 2 ** 53:
        # A whole-number limit keeps the comparison on the stored type.
        limit = F.lit(math.floor(bound) if greater else math.ceil(bound))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        tested = F.col(column)
    test = tested > limit if greater else tested < limit
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        test = test & ~F.isnan(tested)
    kept = df.filter(test)
    return kept if isinstance(kind, T.IntegralType) else kept.withColumn(column, coerced)


def where_greater(df: DataFrame, column: str, value: float) -> DataFrame:
    """Rows with ``column > value``; the column leaves as a number.

    Text that is no number, nulls and NaN never pass.
    """
    return _where_compared(df, column, value, greater=True)


def where_less(df: DataFrame, column: str, value: float) -> DataFrame:
    """Rows with ``column < value``; otherwise as :func:`where_greater`."""
    return _where_compared(df, column, value, greater=False)


def filter_terms(df: DataFrame, terms: str | None) -> DataFrame:
    """All of a comma list of terms ``col=text``, ``col>number``, ``col<number``.

    A term with none of the three signs is warned about and skipped.
    """
    for term in (terms or "").split(",") if terms else ():
        for sign, keep in (("=", where_equals), (">", where_greater), ("<", where_less)):
            if sign in term:
                column, value = (part.strip() for part in term.split(sign, 1))
                df = keep(df, column, value)
                break
        else:
            warnings.warn(f"filter term {term!r} has none of '=', '>', '<'; skipped")
    return df


def required_fields(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column has a value."""
    return df.dropna(subset=list(columns))


def route_topic(records: DataFrame, topic: str) -> DataFrame:
    """The records of one topic."""
    return records.filter(F.col("topic") == topic)
