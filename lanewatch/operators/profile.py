"""Group profiles: eight statistics per column, with an exact distributed median."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lanewatch.functions.values import nan_to_null, number_or_null

STATS = ("count", "min", "max", "mean", "median", "std", "var", "sum")

# Bins per factor of two in the first cut, and bins per remaining range in the
# second: 10 + 21 bits, which leaves at most about 2**22 doubles to a bin.
_BINS_PER_DOUBLING = 1024
_BINS_PER_RANGE = 2 ** 21


def numeric_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: ``non_null`` values, how many are ``numeric``, and the verdict.

    ``status`` is ``ok``, ``empty`` (nothing numeric) or ``mixed`` (some values
    are not numbers).  All columns are judged in one aggregate pass.
    """
    counts = []
    for column in columns:
        c, kind = F.col(column), df.schema[column].dataType
        present = nan_to_null(c) if isinstance(kind, (T.FloatType, T.DoubleType)) else c
        counts += [
            F.count(present).alias(f"{column}_present"),
            F.count(number_or_null(c, kind)).alias(f"{column}_numeric"),
        ]
    rows = F.inline(F.array(*(
        F.struct(
            F.lit(column).alias("column"),
            F.col(f"{column}_present").alias("non_null"),
            F.col(f"{column}_numeric").alias("numeric"),
        )
        for column in columns
    )))
    status = (
        F.when(F.col("numeric") == 0, "empty")
        .when(F.col("numeric") < F.col("non_null"), "mixed")
        .otherwise("ok")
    )
    return df.agg(*counts).select(rows).withColumn("status", status)


def check_profile_arguments(df: DataFrame, keys: list[str], columns: list[str]) -> None:
    """Raise ValueError for missing, overlapping or non-numeric columns.

    The schema settles the first two; numeric columns need no data either, and
    all text columns together cost one aggregate.
    """
    if not keys or not columns:
        raise ValueError("name at least one key and one column to profile")
    missing = [c for c in columns + keys if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) not found: {', '.join(missing)}")
    both = [c for c in columns if c in keys]
    if both:
        raise ValueError(f"column(s) both profiled and grouped by: {', '.join(both)}")
    texts = [c for c in columns if not isinstance(df.schema[c].dataType, T.NumericType)]
    for row in numeric_report(df, texts).collect() if texts else ():  # a row per text column
        if row["status"] == "empty":
            raise ValueError(f"column {row['column']!r} must be numeric")
        if row["status"] == "mixed":
            raise ValueError(f"column {row['column']!r} contains non-numeric values")


def _doubling_bin(v: Column) -> Column:
    """A bin number that never falls as the value grows, from its logarithm."""
    size = F.abs(v)
    step = F.floor(F.log2(size) * _BINS_PER_DOUBLING) + 1100 * _BINS_PER_DOUBLING
    infinite = F.lit(2200 * _BINS_PER_DOUBLING)
    level = F.when(size == float("inf"), infinite).when(size == 0, F.lit(0)).otherwise(step)
    return F.when(v < 0, -level).otherwise(level).cast("long")


def _range_bin(v: Column, low: Column, high: Column) -> Column:
    """Equal-width bins between the bin's smallest and largest value."""
    return F.when(low == high, F.lit(0)).otherwise(
        F.floor((v - low) / (high - low) * _BINS_PER_RANGE)
    ).cast("long")


def _running(keys: list[str], *order: str):
    return (
        Window.partitionBy(*keys).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def exact_medians(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Median per group and column, exact at any group size.

    Equal values are counted together before the first shuffle, which spreads
    by value.  The middle ranks are then looked up in bin counts, twice, each
    time keeping only the one or two bins they fall in.  A window sees bin
    counts or one bin's values, never a group's rows, so a group holding a
    third of the table costs no task more than a few million rows.
    Null keys and missing values are left out.
    """
    entries = F.inline(F.array(*(
        F.struct(
            F.lit(i).alias("_which"),
            number_or_null(F.col(c), df.schema[c].dataType).cast("double").alias("_v"),
        )
        for i, c in enumerate(columns)
    )))
    group = [*keys, "_which"]
    counted = (
        df.dropna(subset=keys).select(*keys, entries).filter(F.col("_v").isNotNull())
        .groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_b1", _doubling_bin(F.col("_v")))
    )

    def holds_a_middle_rank(before: Column, through: Column) -> Column:
        return (before < F.col("_rank_hi")) & (through >= F.col("_rank_lo"))

    # Cut 1: bins by magnitude.
    first = counted.groupBy(*group, "_b1").agg(
        F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    total = F.sum("_n").over(Window.partitionBy(*group))
    first = first.withColumns({
        "_through": F.sum("_n").over(_running(group, "_b1")),
        "_rank_lo": F.floor((total + 1) / 2),
        "_rank_hi": F.floor((total + 2) / 2),
    }).withColumn("_before1", F.col("_through") - F.col("_n"))
    first = first.filter(holds_a_middle_rank(F.col("_before1"), F.col("_through"))).select(
        *group, "_b1", "_before1", "_low", "_high", "_rank_lo", "_rank_hi"
    )

    # Cut 2: equal ranges inside those bins.
    inside = counted.join(first, [*group, "_b1"]).withColumn(
        "_b2", _range_bin(F.col("_v"), F.col("_low"), F.col("_high"))
    )
    bin2 = [*group, "_b1", "_b2"]
    second = inside.groupBy(*bin2, "_before1", "_rank_lo", "_rank_hi").agg(
        F.sum("_n").alias("_n")
    )
    second = second.withColumn(
        "_through", F.col("_before1") + F.sum("_n").over(_running([*group, "_b1"], "_b2"))
    ).withColumn("_before2", F.col("_through") - F.col("_n"))
    second = second.filter(holds_a_middle_rank(F.col("_before2"), F.col("_through"))).select(
        *bin2, "_before2"
    )

    # The values of the bins that are left.
    final = inside.join(second, bin2).withColumn(
        "_through", F.col("_before2") + F.sum("_n").over(_running(bin2, "_v"))
    )
    before = F.col("_through") - F.col("_n")

    def at_rank(which: int, rank: str) -> Column:
        hit = (F.col("_which") == which) & (before < F.col(rank)) & (
            F.col("_through") >= F.col(rank))
        return F.max(F.when(hit, F.col("_v")))

    def middle(i: int) -> Column:
        low, high = at_rank(i, "_rank_lo"), at_rank(i, "_rank_hi")
        return F.when(low == high, low).otherwise((low + high) / 2)

    return final.groupBy(*keys).agg(
        *(middle(i).alias(f"{c}_median") for i, c in enumerate(columns))
    )


def group_profile(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    median: str = "exact",
    ordered: bool = False,
    check: bool = True,
) -> DataFrame:
    """Count, min, max, mean, median, std, var and sum of columns per group.

    Output columns are the keys, then ``{column}_{stat}``.  Groups with a null
    key are left out; NaN counts as missing; std and var are those of a sample,
    null for a single value; the sum of nothing is 0.

    median: ``exact`` works at any group size.  ``approx`` is one pass with a
    bounded sketch.  ``single_pass`` is one exact pass that holds a group's
    distinct values in memory, for groups known to be small.
    """
    if median not in ("exact", "approx", "single_pass"):
        raise ValueError(f"unknown median mode {median!r}")
    if check:
        check_profile_arguments(df, keys, columns)
    kept = df.dropna(subset=keys)
    for c in columns:
        kept = kept.withColumn(c, number_or_null(F.col(c), df.schema[c].dataType))
    stats: list[Column] = []
    for c in columns:
        value = F.col(c)
        real = value.cast("double")
        by_stat = {
            "count": F.count(value),
            "min": F.min(value),
            "max": F.max(value),
            "mean": F.avg(real),
            "std": F.stddev_samp(real),
            "var": F.var_samp(real),
            "sum": F.coalesce(F.sum(value), F.lit(0).cast(kept.schema[c].dataType)),
        }
        if median == "approx":
            by_stat["median"] = F.percentile_approx(real, 0.5, 10_000)
        elif median == "single_pass":
            by_stat["median"] = F.median(real)
        stats += [expr.alias(f"{c}_{stat}") for stat, expr in by_stat.items()]
    result = kept.groupBy(*keys).agg(*stats)
    if median == "exact":
        result = result.join(exact_medians(df, keys, columns), keys, "left")
    result = result.select(*keys, *(f"{c}_{stat}" for c in columns for stat in STATS))
    return result.orderBy(*keys) if ordered else result
