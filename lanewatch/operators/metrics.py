"""Row counts: as a table, and observed while a job runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def count_rows(df: DataFrame) -> DataFrame:
    """One row, one column ``count``.  A sort underneath is dropped by the optimizer."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass this point of a batch job, at no extra job.

    Read ``observation.get["rows"]`` after the action has run.  Above a global
    sort only: below one, the sort's sampling pass would be counted as well.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def rows_per(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Records per key, as ``records``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))
