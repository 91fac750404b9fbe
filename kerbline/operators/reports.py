"""Demand, violation and dwell reports: small tables out of one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions import calendar
from kerbline.plans.durable import attach
from kerbline.plans.quantiles import quantiles

HOURS = list(range(24))


def kpi_rates(df: DataFrame, occupied: str = "occupied", violation: str = "in_violation") -> DataFrame:
    return df.agg(
        F.avg(occupied).alias("avg_occupancy"),
        F.avg(F.col(violation).cast("int")).alias("avg_violation_rate"),
    )


def class_balance(df: DataFrame, column: str, labels: dict | None = None) -> DataFrame:
    """Rows and share per value, most frequent first; null is left out. `labels` names values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("count")
    )
    total = df.agg(F.count(column)).scalar()
    shown = F.col(column)
    if labels:
        pairs = [F.lit(x) for pair in labels.items() for x in pair]
        shown = F.try_element_at(F.create_map(*pairs), F.col(column))
    return counts.select(
        shown.alias("status" if labels else column), "count", (F.col("count") / total).alias("share")
    ).orderBy(F.desc("count"), "status" if labels else column)


def _occupancy_by(df: DataFrame, key: str, occupied: str) -> DataFrame:
    known = df.filter(F.col(key).isNotNull())
    return (
        known.groupBy(key)
        .agg(F.count(occupied).alias("events"), F.avg(occupied).alias("occ_rate"))
        .orderBy(key)
    )


def occ_by_hour(df: DataFrame, hour: str = "hour", occupied: str = "occupied") -> DataFrame:
    return _occupancy_by(df, hour, occupied)


def occ_by_dow(df: DataFrame, dow: str = "dow0", occupied: str = "occupied") -> DataFrame:
    return _occupancy_by(df, dow, occupied)


def top_k(df: DataFrame, by: Sequence, k: int) -> DataFrame:
    """First `k` rows of an order; each task keeps only its own best."""
    return df.orderBy(*by).limit(k)


def _by_street(df: DataFrame, street: str, occupied: str) -> DataFrame:
    return (
        df.filter(F.col(street).isNotNull())
        .groupBy(street)
        .agg(F.count(F.lit(1)).alias("events"), F.avg(occupied).alias("occ_rate"))
    )


def occ_by_street(
    df: DataFrame, k: int = 25, street: str = "street_marker", occupied: str = "occupied"
) -> DataFrame:
    """All rows and the rate per street, highest rate first."""
    order = [F.desc_nulls_last("occ_rate"), F.desc("events"), F.col(street)]
    return top_k(_by_street(df, street, occupied), order, k)


def street_hour_pivot(
    df: DataFrame,
    k: int = 10,
    street: str = "street_marker",
    hour: str = "hour",
    occupied: str = "occupied",
) -> DataFrame:
    """Rate of the `k` busiest streets by hour, a column per hour."""
    busiest = top_k(
        _by_street(df, street, occupied), [F.desc("events"), F.col(street)], k
    ).select(street)
    chosen = df.join(F.broadcast(busiest), street, "left_semi")
    wide = chosen.groupBy(street).pivot(hour, HOURS).agg(F.avg(occupied))
    return wide.select(street, *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in HOURS])


def day_hour_heatmap(
    df: DataFrame, dow: str = "dow", hour: str = "hour", occupied: str = "occupied"
) -> DataFrame:
    """Rate by weekday and hour; every weekday is there, Sunday first."""
    wide = df.groupBy(dow).pivot(hour, HOURS).agg(F.avg(occupied))
    day = F.col("id").cast("int")
    days = df.sparkSession.range(1, 8).select(
        day.alias("dow"), calendar.day_name(day).alias("day_name")
    )
    filled = days.join(F.broadcast(wide.withColumnRenamed(dow, "dow")), "dow", "left")
    return filled.select(
        "dow", "day_name", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in HOURS]
    ).orderBy("dow")


def _top_rates(df: DataFrame, key: str, value, rate: str, min_n: int, k: int) -> DataFrame:
    stats = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(value).alias(rate), F.count(value).alias("count"))
        .filter(F.col("count") >= min_n)
    )
    return top_k(stats, [F.desc(rate), F.col(key)], k)


def top_streets(
    df: DataFrame,
    min_n: int = 50,
    k: int = 10,
    street: str = "street_marker",
    occupied: str = "occupied",
) -> DataFrame:
    """Streets with the highest rate among those with enough known events."""
    return _top_rates(df, street, F.col(occupied), "occ_rate", min_n, k)


def violation_by_area(
    df: DataFrame,
    min_n: int = 50,
    k: int = 10,
    area: str = "area_name",
    violation: str = "in_violation",
) -> DataFrame:
    return _top_rates(df, area, F.col(violation).cast("int"), "violation_rate", min_n, k)


def daily_trend(
    df: DataFrame, column: str = "event_time", occupied: str = "occupied"
) -> DataFrame:
    """Events and rate per day from the first to the last; a day without events has 0 and null."""
    timed = df.filter(F.col(column).isNotNull())
    daily = timed.groupBy(F.to_date(column).alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.avg(occupied).alias("occ_rate")
    )
    span = daily.agg(F.min("day").alias("_from"), F.max("day").alias("_to"))
    days = span.filter(F.col("_from").isNotNull()).select(
        F.explode(F.sequence("_from", "_to")).alias("day")
    )
    return (
        days.join(daily, "day", "left")
        .select("day", F.coalesce("events", F.lit(0)).alias("events"), "occ_rate")
        .orderBy("day")
    )


def street_cv(
    df: DataFrame, k: int = 15, street: str = "street_marker", occupied: str = "occupied"
) -> DataFrame:
    """Streets whose occupancy varies most: sample deviation over the rate, null at rate 0."""
    stats = (
        df.filter(F.col(street).isNotNull())
        .groupBy(street)
        .agg(
            F.avg(occupied).alias("occ_rate"),
            F.count(F.lit(1)).alias("events"),
            F.stddev_samp(occupied).alias("std"),
        )
        .withColumn("cv", F.col("std") / F.nullif(F.col("occ_rate"), F.lit(0.0)))
    )
    best = top_k(stats, [F.desc_nulls_last("cv"), F.col(street)], k)
    return best.select(
        street, F.round("occ_rate", 3).alias("occ_rate"), "events",
        F.round("std", 3).alias("std"), F.round("cv", 3).alias("cv"),
    )


def _all_bins(counts: DataFrame, bins: int) -> DataFrame:
    every = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").withColumn(
        "count", F.coalesce("count", F.lit(0))
    )


def dwell_histogram(
    df: DataFrame,
    low: float = 0,
    high: float = 240,
    bins: int = 40,
    column: str = "duration_min",
) -> DataFrame:
    """Counts in equal bins from `low` to `high`; the top edge belongs to the last bin."""
    width = (high - low) / bins
    inside = df.filter(F.col(column).between(low, high))
    place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
    counts = inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return (
        _all_bins(counts, bins)
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_start"),
            (low + (F.col("bin") + 1) * width).alias("bin_end"),
            "count",
        )
        .orderBy("bin")
    )


def duration_histogram(
    df: DataFrame, upper: float = 1440, bins: int = 50, column: str = "duration_min"
) -> DataFrame:
    """Counts in equal bins between the least and the greatest value, cut at `upper` first.

    A single value gets a range of one around it.
    """
    cut = df.filter(F.col(column).isNotNull()).select(
        F.least(F.col(column), F.lit(float(upper))).alias("_x")
    )
    least, most = F.min("_x"), F.max("_x")
    pad = F.when(least == most, 0.5).otherwise(0.0)
    ends = cut.agg(F.struct((least - pad).alias("a"), (most + pad).alias("b"))).scalar()
    a, b = F.col("_e.a"), F.col("_e.b")
    place = F.least(F.floor((F.col("_x") - a) * bins / (b - a)), F.lit(bins - 1)).cast("int")
    counts = (
        cut.withColumn("_e", ends)
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    edged = _all_bins(counts, bins).withColumn("_e", ends)
    return edged.select(
        "bin",
        (a + F.col("bin") * (b - a) / bins).alias("bin_start"),
        (a + (F.col("bin") + 1) * (b - a) / bins).alias("bin_end"),
        "count",
    ).orderBy("bin")


def dwell_by_violation(
    df: DataFrame,
    low: float = 0,
    high: float = 240,
    column: str = "duration_min",
    violation: str = "in_violation",
) -> DataFrame:
    """Box-plot numbers per violation flag; whiskers end at the last value within 1.5 IQR."""
    rows = df.filter(F.col(column).between(low, high) & F.col(violation).isNotNull()).select(
        F.col(violation).cast("int").alias("violation"), F.col(column).alias("_x")
    )
    q = quantiles(rows, "_x", [0.25, 0.5, 0.75], ["violation"]).select(
        "violation",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return (
        attach(rows, q, ["violation"], "inner")
        .groupBy("violation", "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("_x").alias("min"),
            F.max("_x").alias("max"),
            F.min(F.when(F.col("_x") >= F.col("q1") - reach, F.col("_x"))).alias("whisker_low"),
            F.max(F.when(F.col("_x") <= F.col("q3") + reach, F.col("_x"))).alias("whisker_high"),
        )
    )
