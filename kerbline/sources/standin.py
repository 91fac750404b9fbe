"""Sensor rows out of the generic `events` table, for checks and timings.

The mapping is a plain projection: user to device, a number in `props` to street and area, `value` to
minutes parked, event type to status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.functions import calendar, texts
from kerbline.session import use_utc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def sensors(spark: SparkSession, folder: str) -> DataFrame:
    """Typed sensor events."""
    street = F.get_json_object("props", "$.k").cast("int")
    arrive = F.col("ts").cast("timestamp")
    stay = F.round(F.col("value") * 60e6).cast("bigint")
    status = (
        F.when(F.col("event_type").isin("click", "purchase"), "Present")
        .when(F.col("event_type").isin("view", "signup"), "NotPresent")
        .otherwise("unknown")
    )
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("bay_id"),
        F.col("user_id").cast("string").alias("device_id"),
        street.alias("k"),
        F.concat(F.lit("S"), street.cast("string")).alias("street_marker"),
        F.concat(F.lit("A"), (street % 10).cast("string")).alias("area_name"),
        arrive.alias("arrive_ts"),
        F.timestamp_micros(F.unix_micros(arrive) + stay).alias("depart_ts"),
        arrive.alias("event_time"),
        F.col("value").alias("duration_min"),
        status.alias("status"),
        (F.col("value") > 150).alias("in_violation"),
    )


def dated(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor events with occupied (unknown null) and the calendar columns the reports use."""
    when = F.col("event_time")
    return sensors(spark, folder).withColumns(
        {
            "occupied": texts.occupied_flag(F.col("status")),
            "hour": F.hour(when),
            "dow": calendar.dow(when),
            "dow0": calendar.dow0(when),
            "is_weekend": calendar.weekend(calendar.dow(when)),
        }
    )


def loose(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a loose export: text columns in four time formats, some of it unusable."""
    rows = sensors(spark, folder)
    number = F.col("event_id")

    form = (
        F.when(number % 4 == 0, "$1-$2-$3 $4")
        .when(number % 4 == 1, "$2/$3/$1 $4")
        .when(number % 4 == 2, "$3/$2/$1 $4")
        .otherwise("$1-$2-$3T$4")
    )

    def text(ts):
        iso = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
        arranged = F.regexp_replace(iso, F.lit("^(....)-(..)-(..) (.*)$"), form)
        return F.when(number % 97 == 0, "n/a").otherwise(arranged)

    minutes = F.when(number % 11 == 0, "abc").when(number % 7 != 0, F.col("duration_min").cast("string"))
    return rows.select(
        "event_id",
        F.col("bay_id").alias("BayId"),
        F.concat(F.lit(" d  "), "device_id", F.lit(" ")).alias("DeviceId"),
        F.concat(F.lower("street_marker"), F.lit("  x")).alias("StreetMarker"),
        (F.col("k") + F.lit(0.5)).cast("string").alias("SignPlateID"),
        F.concat(F.lit(" "), F.upper("status")).alias("Status"),
        text(F.col("arrive_ts")).alias("ArrivalTime"),
        text(F.col("depart_ts")).alias("DepartureTime"),
        minutes.alias("DurationMinutes"),
        F.when(number % 13 == 0, F.lit(None))
        .when(F.col("status") == "Present", "TRUE")
        .when(F.col("status") == "NotPresent", "no")
        .otherwise("maybe")
        .alias("VehiclePresent"),
        F.col("area_name").alias("AreaName"),
        F.col("in_violation").alias("InViolation"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """A label, a score made of the row number and the prediction at one half."""
    prob = (F.col("event_id") * 7919 % 1000) / F.lit(1000.0)
    return dated(spark, folder).select(
        "event_id",
        F.coalesce("occupied", F.lit(0)).cast("double").alias("label"),
        (prob >= 0.5).cast("double").alias("prediction"),
        prob.alias("prob_occupied"),
    )
