"""Time columns that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_start(ts: Column) -> Column:
    return F.to_date(ts)


def hour_start(ts: Column) -> Column:
    """Start of the hour, kept as ``timestamp_ntz`` (date_trunc would add a zone)."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


# Seconds that a timestamp of 64 bits of microseconds can hold, either way.
SECONDS_HELD = 9_223_372_036_854.0


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds, fractions kept, as UTC ``timestamp_ntz``, from the year -290308 to 294247.

    NULL for numbers beyond that, NaN among them, which have no timestamp.
    """
    seconds = F.when(F.abs(seconds) < SECONDS_HELD, seconds)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    whole = F.floor(seconds)
    micros = F.round((seconds - whole) * 1_000_000)
    days = F.floor(whole / 86400).try_cast("int")
    secs = (whole % 86400 + 86400) % 86400 + micros / 1_000_000
    return epoch + F.make_dt_interval(days, F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


def weekday(day: Column) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return F.dayofweek(day) - 1


# Time bucket per grain: output key and the column builder.
GRAINS = {"hour": ("event_hour", hour_start), "day": ("event_day", day_start)}
