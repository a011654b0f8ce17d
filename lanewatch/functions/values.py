"""Tolerant numbers, null handling and number text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INFINITE_TEXT = r"(?i)^[+-]?inf(inity)?$"


def nan_to_null(c: Column) -> Column:
    """NaN means missing; Spark would order it above every number."""
    return F.when(~F.isnan(c), c)


def number_or_null(c: Column, kind: T.DataType) -> Column:
    """A column as a number, anything that is not one as null.

    Integers keep their type.  Text is trimmed and must be a plain decimal
    (Java's ``1.0d`` is refused) or an infinity.
    """
    if isinstance(kind, T.IntegralType):
        return c
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return nan_to_null(c)
    if isinstance(kind, (T.DecimalType, T.BooleanType)):
        return c.cast("double")
    if isinstance(kind, T.StringType):
        text = F.trim(c)
        finite = F.when(text.rlike(_DECIMAL_TEXT), text.try_cast("double"))
        infinite = F.when(
            text.rlike(_INFINITE_TEXT),
            F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
        )
        return F.coalesce(finite, infinite)
    return F.lit(None).cast("double")


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def decimal_attribute(c: Column) -> Column:
    """A blank or malformed attribute is null; the rest of the record stays."""
    return nan_to_null(F.trim(c).try_cast("double"))


def rounded_half_up(c: Column, digits: int) -> Column:
    """What ``F.round`` makes of a double, which goes through its decimal text.

    Arithmetic gives the same number unless the digits behind are very nearly a half, or the
    number is large; only then it is left to ``F.round``.
    """
    scale = float(10 ** digits)
    scaled = c * F.lit(scale)
    whole = F.rint(scaled)
    plain = (F.abs(scaled) < F.lit(1e9)) & (F.abs(scaled - whole) < F.lit(0.499999))
    # A negative zero plus zero is zero.
    return F.when(plain, (whole + F.lit(0.0)) / F.lit(scale)).otherwise(F.round(c, digits))


def fixed_digits(c: Column, digits: int = 2) -> Column:
    """``12.346 -> '12.35'``; null gives ``N/A``.

    Rounded on the exact value, halves to even, as ``format_number`` does;
    ``%.2f`` would round halves of the shortest decimal form up.
    """
    plain = F.replace(F.format_number(c, digits), F.lit(","), F.lit(""))
    return F.coalesce(plain, F.lit("N/A"))
