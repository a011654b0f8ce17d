"""Epoch and text forms of time, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: 2026-05-01T00:00:00Z, the moment simulation second 0 stands for.
SIMULATION_BASE_MS = 1_777_593_600_000


def millis_to_timestamp(ms: Column) -> Column:
    """Epoch milliseconds, kept to the millisecond and free of the session zone."""
    return F.timestamp_millis(ms)


def simulation_millis(seconds: Column, base_ms: int = SIMULATION_BASE_MS) -> Column:
    """Simulation time to epoch milliseconds; fractions of a second are cut off."""
    return F.lit(base_ms) + seconds.cast("long") * F.lit(1000)


def _plain_text(ts: Column) -> Column:
    """``2026-05-01T00:00:00``, with a fraction only where there is one, zeros cut.

    Counted from the epoch without a zone, so the text is UTC in any session.
    """
    seconds = (F.unix_micros(ts).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.replace(utc.cast("string"), F.lit(" "), F.lit("T"))


def iso_instant(ts: Column) -> Column:
    """``2026-05-01T00:00:00Z``; a fraction has three or six digits."""
    text = _plain_text(ts)
    size = F.length(text)
    digits = F.when(size == 19, 19).when(size <= 23, 23).otherwise(26)
    return F.concat(F.rpad(text, digits, F.lit("0")), F.lit("Z"))


def epoch_seconds_to_iso(seconds: Column) -> Column:
    """``2026-05-01T00:00:00.250000``; the fraction is left out when it is zero."""
    text = _plain_text(F.timestamp_micros(F.round(seconds * 1_000_000).cast("long")))
    return F.when(F.length(text) == 19, text).otherwise(F.rpad(text, 26, "0"))
