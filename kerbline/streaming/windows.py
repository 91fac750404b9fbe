"""Sliding-window occupancy per street, the same plan for a stream and for a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.functions.times import micros
from kerbline.operators.cleaning import parse_event_times

MINUTE = 60 * 1_000_000


def stream_events(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Stream of event files dropped into a folder; unusable rows are skipped."""
    files = (
        spark.readStream.schema(schemas.STREAM_EVENT)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )
    return parse_event_times(files)


def window_occupancy(
    events: DataFrame,
    watermark: str = "10 minutes",
    size: str = "5 minutes",
    slide: str = "1 minute",
) -> DataFrame:
    """Rate to three digits and event count per window and street.

    On a stream, events older than the watermark are dropped. On a table the watermark does nothing.
    """
    if events.isStreaming:
        events = events.withWatermark("event_time_ts", watermark)
    return (
        events.groupBy(F.window("event_time_ts", size, slide).alias("window"), "street_marker")
        .agg(
            F.round(F.avg("occupied"), 3).alias("occupancy_rate"),
            F.count(F.lit(1)).alias("event_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "street_marker",
            "occupancy_rate",
            "event_count",
        )
    )


def sorted_windows(windows: DataFrame) -> DataFrame:
    """Windows in time and street order: for tables, or for a stream in complete mode."""
    return windows.orderBy("window_start", "street_marker")


def occupancy_change(windows: DataFrame, minutes: int = 5) -> DataFrame:
    """Rate of each window minus the rate `minutes` earlier; null where no such window exists.

    A street has one row per window here, so its order is as long as time, not as its events.
    """
    before = (
        Window.partitionBy("street_marker")
        .orderBy(micros(F.col("window_start")))
        .rangeBetween(-minutes * MINUTE, -minutes * MINUTE)
    )
    return windows.withColumn(
        "occupancy_change",
        F.round(F.col("occupancy_rate") - F.max("occupancy_rate").over(before), 3),
    )


def occupancy_change_stream(
    events: DataFrame,
    minutes: int = 5,
    watermark: str = "10 minutes",
    size: str = "5 minutes",
    slide: str = "1 minute",
) -> DataFrame:
    """The same for a stream: each closed window once, with the change against `minutes` earlier.

    The stream of closed windows is joined to itself with the starts shifted. Both sides keep a window
    until the watermark has passed the time at which its partner could still come, so the state is
    bounded by the watermark and `minutes`, and a window without a partner is given out with null then.
    """
    closed = (
        events.withWatermark("event_time_ts", watermark)
        .groupBy(F.window("event_time_ts", size, slide).alias("window"), "street_marker")
        .agg(F.round(F.avg("occupied"), 3).alias("occupancy_rate"), F.count(F.lit(1)).alias("event_count"))
        .withColumn("_at", F.window_time("window"))
    )
    now = closed.select(
        F.col("_at").alias("now_at"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "street_marker", "occupancy_rate", "event_count",
    )
    before = closed.select(
        F.col("_at").alias("before_at"),
        F.col("street_marker").alias("before_street"),
        F.col("occupancy_rate").alias("before_rate"),
    )
    shift = F.expr(f"INTERVAL {minutes} MINUTES")
    same = (
        F.col("street_marker").eqNullSafe(F.col("before_street"))
        & (F.col("now_at") >= F.col("before_at") + shift)
        & (F.col("now_at") <= F.col("before_at") + shift)
    )
    return now.join(before, same, "leftOuter").select(
        "window_start", "window_end", "street_marker", "occupancy_rate", "event_count",
        F.round(F.col("occupancy_rate") - F.col("before_rate"), 3).alias("occupancy_change"),
    )
