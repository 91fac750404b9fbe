"""Calendar features of a time or of an hour and weekday.

Day numbers: `dow` is 1 = Sunday to 7 = Saturday, `dow0` is 0 = Monday to 6 = Sunday. Weekend is
Saturday and Sunday in both.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday labels by `dow`.
DAY_NAMES = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}


def dow(ts: Column) -> Column:
    return F.dayofweek(ts)


def dow0(ts: Column) -> Column:
    return F.weekday(ts)


def weekend(day: Column) -> Column:
    """0/1 from a `dow` number."""
    return day.isin(1, 7).cast("int")


def part_of_day(hour: Column) -> Column:
    """Night to 5, Morning to 11, Afternoon to 16, Evening to 21, then Night again."""
    return (
        F.when(hour.between(6, 11), "Morning")
        .when(hour.between(12, 16), "Afternoon")
        .when(hour.between(17, 21), "Evening")
        .when(hour.between(0, 23), "Night")
    )


def day_name(day: Column) -> Column:
    """Label of a `dow` number, null beyond 1 to 7."""
    pairs = [F.lit(x) for pair in DAY_NAMES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), day)


def rush_bucket(hour: Column) -> Column:
    """1 in the morning rush (7 to 10), 2 in the evening rush (16 to 19), else 0."""
    return F.when(hour.between(7, 10), 1).when(hour.between(16, 19), 2).otherwise(0)


def named_bucket(hour: Column) -> Column:
    return (
        F.when((hour >= 7) & (hour < 11), "morning")
        .when((hour >= 11) & (hour < 16), "midday")
        .when((hour >= 16) & (hour < 21), "evening")
        .otherwise("overnight")
    )


def business_peak(day: Column, hour: Column) -> Column:
    """0/1: Monday to Friday by `dow`, 8 to 18 o'clock."""
    return (day.between(2, 6) & hour.between(8, 18)).cast("int")


def on_circle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)
