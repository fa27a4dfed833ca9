"""Time arithmetic on zone-less stamps.

Every expression is independent of the session zone for `timestamp_ntz` input.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a zone-less stamp."""
    ts = col(ts)
    days = F.unix_date(ts.cast("date")).cast("long")
    return days * DAY + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less stamp."""
    ts = col(ts)
    fraction = F.extract(F.lit("SECOND"), ts) * 1_000_000
    minutes = F.unix_date(ts.cast("date")).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60_000_000 + fraction.cast("long")


def plus_seconds(ts: str | Column, seconds: int | Column) -> Column:
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    zero = F.lit(0)
    return col(ts) + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def floor_time(ts: str | Column, unit: str) -> Column:
    """Start of the minute, hour or day; unlike `date_trunc` it never passes through a zone."""
    step = F.lit({"minute": 60, "hour": 3600, "day": DAY}[unit])
    return plus_seconds(stamp("1970-01-01"), F.floor(epoch_seconds(ts) / step) * step)


def stamp(value: str | datetime) -> Column:
    """A zone-less stamp literal from text or a naive datetime."""
    return F.lit(str(value)).cast("timestamp_ntz")


def day_block(ts: str | Column, days: int) -> Column:
    """Number of the block of `days` days a stamp falls in; grows with the stamp."""
    return F.floor(F.unix_date(col(ts).cast("date")) / F.lit(days)).cast("long")


def utc_text_to_local(text: str | Column, fmt: str, offset: str) -> Column:
    """UTC text to a zone-less local stamp at a fixed offset such as `-06:00`.

    Parsed as zone-less, so the session zone has no part in it.
    """
    sign = -1 if offset.startswith("-") else 1
    hours, minutes = offset.lstrip("+-").split(":")
    shift = sign * (int(hours) * 3600 + int(minutes) * 60)
    return plus_seconds(F.to_timestamp_ntz(col(text), F.lit(fmt)), shift)


def iso_local(ts: str | Column) -> Column:
    """`yyyy-MM-ddTHH:mm:ss` of a zone-less stamp."""
    return F.replace(F.substring(col(ts).cast("string"), 1, 19), F.lit(" "), F.lit("T"))
