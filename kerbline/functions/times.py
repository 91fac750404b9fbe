"""Column expressions over times: parsing, zones, epoch numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MICROS = 3600 * 1_000_000

SLASHED = r"^([0-9]{2})/([0-9]{2})/([0-9]{4})( [0-9]{2}:[0-9]{2}:[0-9]{2})$"
DASHED = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def parse_ts(text: Column) -> Column:
    """ISO, else month/day/year, else day/month/year; text that fits none is null.

    A slashed date is turned into ISO text and cast. Parsing by pattern would raise and catch an
    error for every row that a pattern does not fit.
    """
    month_first = F.regexp_replace(text, SLASHED, "$3-$1-$2$4")
    day_first = F.regexp_replace(text, SLASHED, "$3-$2-$1$4")
    return F.coalesce(*[t.try_cast("timestamp") for t in (text, month_first, day_first)])


def parse_event_time(text: Column) -> Column:
    """Stream times: a `+hh:mm` offset is cut off, whatever else follows makes the time null."""
    local = F.substring_index(text, "+", 1)
    return F.when(local.rlike(DASHED), local.try_cast("timestamp"))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, as a long that windows and buckets can use."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds of each side subtracted."""
    return F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))


def to_utc(local: Column, zone: str) -> Column:
    """Zone-less local time to UTC.

    In a spring gap the first valid instant is taken. A time that happens twice in autumn is
    null. Holds for zones that shift by one hour at a whole hour.
    """
    utc = F.to_utc_timestamp(local, zone)
    hour_later = F.timestamp_micros(F.unix_micros(utc) + HOUR_MICROS)
    happens_twice = F.from_utc_timestamp(hour_later, zone) == local
    in_gap = F.from_utc_timestamp(utc, zone) != local
    return (
        F.when(happens_twice, F.lit(None).cast("timestamp"))
        .when(in_gap, F.date_trunc("hour", utc))
        .otherwise(utc)
    )


def in_zone(utc: Column, zone: str) -> Column:
    """Wall clock of a UTC time in a zone."""
    return F.from_utc_timestamp(utc, zone)
