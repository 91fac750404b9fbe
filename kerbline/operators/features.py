"""Row-wise features and the joins that bring group facts onto rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions import calendar
from kerbline.plans.durable import attach, durable
from kerbline.plans.limits import limit, table_bytes
from kerbline.plans.quantiles import count_values, quantile_values, quantiles_of
from kerbline.plans.slices import positions

OTHER = "_OTHER"


def calendar_parts(df: DataFrame, column: str = "event_time") -> DataFrame:
    """hour, dow (1 = Sunday), dow0 (0 = Monday), month and day of month."""
    when = F.col(column)
    return df.withColumns(
        {
            "hour": F.hour(when),
            "dow": calendar.dow(when),
            "dow0": calendar.dow0(when),
            "month": F.month(when),
            "day_of_month": F.dayofmonth(when),
        }
    )


def is_weekend(df: DataFrame, column: str = "event_time") -> DataFrame:
    return df.withColumn("is_weekend", calendar.weekend(calendar.dow(F.col(column))))


def part_of_day(df: DataFrame, hour: str = "hour") -> DataFrame:
    return df.withColumn("part_of_day", calendar.part_of_day(F.col(hour)))


def day_name(df: DataFrame, dow: str = "dow") -> DataFrame:
    return df.withColumn("day_name", calendar.day_name(F.col(dow)))


def log_duration(df: DataFrame, column: str = "duration_min") -> DataFrame:
    return df.withColumn("log_duration_min", F.log1p(column))


def hour_bucket_num(df: DataFrame, hour: str = "hour") -> DataFrame:
    """Rush-hour number and the 0/1 flag for any rush hour."""
    bucket = calendar.rush_bucket(F.col(hour))
    return df.withColumns({"hour_bucket": bucket, "is_peak": (bucket != 0).cast("int")})


def hour_bucket_name(df: DataFrame, hour: str = "hour") -> DataFrame:
    return df.withColumn("hour_bucket", calendar.named_bucket(F.col(hour)))


def is_peak(df: DataFrame, dow: str = "dow", hour: str = "hour") -> DataFrame:
    return df.withColumn("is_peak", calendar.business_peak(F.col(dow), F.col(hour)))


def interactions(df: DataFrame) -> DataFrame:
    weekend = F.col("is_weekend").cast("double")
    return df.withColumns(
        {"hour_x_weekend": F.col("hour") * weekend, "dow_x_weekend": F.col("dow") * weekend}
    )


def cyclic_time(df: DataFrame) -> DataFrame:
    hour_sin, hour_cos = calendar.on_circle(F.col("hour"), 24)
    dow_sin, dow_cos = calendar.on_circle(F.col("dow"), 7)
    return df.withColumns(
        {"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos}
    )


def target_occupied(df: DataFrame, source: str = "occupied") -> DataFrame:
    """Model target: unknown counts as vacant."""
    return df.withColumn("target_occupied", F.coalesce(F.col(source), F.lit(0)).cast("int"))


def street_target_stats(
    df: DataFrame, street: str = "street_marker", label: str = "label", fit_on: DataFrame | None = None
) -> DataFrame:
    """Mean duration and label rate of the row's street, fitted on `fit_on` or the rows themselves."""
    stats = (
        (df if fit_on is None else fit_on)
        .groupBy(street)
        .agg(
            F.avg("duration_min").alias("avg_duration_per_marker"),
            F.avg(label).alias("occ_rate_per_marker"),
        )
    )
    return attach(df, stats, [street])


def impute_duration(
    df: DataFrame, column: str = "duration_min", street: str = "street_marker"
) -> DataFrame:
    """`duration_min_imp`: the value, else the median of its street, else of all rows."""
    # One table of counted values serves the streets and, added up, all rows.
    counts = count_values(df, column, [street])
    local = quantiles_of(counts.filter(F.col(street).isNotNull()), [0.5], [street])
    (overall,) = quantile_values(counts.groupBy("_x").agg(F.sum("_n").alias("_n")), [0.5])
    filled = attach(df, local.select(street, F.col("q")[0].alias("_median")), [street])
    value = F.coalesce(F.col(column), "_median", F.lit(overall).cast("double"))
    return filled.withColumn("duration_min_imp", value).drop("_median")


def lump_rare(
    df: DataFrame,
    column: str,
    min_count: int,
    name: str | None = None,
    other: str = OTHER,
) -> DataFrame:
    """Categories with fewer than `min_count` rows become one."""
    common = (
        df.groupBy(column)
        .count()
        .filter((F.col("count") >= min_count) & F.col(column).isNotNull())
        .select(column, F.lit(True).alias("_common"))
    )
    lumped = F.when(F.col("_common"), F.col(column)).otherwise(F.lit(other))
    return attach(df, common, [column]).withColumn(name or f"{column}_lumped", lumped).drop("_common")


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Categories with `<column>_idx`: most frequent first, ties in alphabetical order."""
    counts = durable(df.filter(F.col(column).isNotNull()).groupBy(column).count())
    order = [F.col("count").desc(), F.col(column)]
    name = f"{column}_idx"
    if table_bytes(counts) <= limit(df.sparkSession, "broadcastBytes"):
        ranked = counts.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)
    else:
        ranked = positions(counts, order, name)
    return ranked.select(column, F.col(name).cast("double").alias(name))


def index_categories(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """Add `<column>_idx`; null and unseen categories share the index after the last one."""
    for column in columns:
        lookup = category_index(df if fit_on is None else fit_on, column)
        name = f"{column}_idx"
        unseen = lookup.agg(F.count(F.lit(1)).cast("double")).scalar()
        df = attach(df, lookup, [column]).withColumn(name, F.coalesce(F.col(name), unseen))
    return df
