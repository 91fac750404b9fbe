"""Cleaning and row-wise features over the stand-in tables, with their SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from kerbline.checks.common import BASE, BRONZE, DATED, LOOSE, SENSORS, parsed, plain, sql
from kerbline.functions import calendar, texts, times
from kerbline.operators import cleaning as c
from kerbline.operators import features as f
from kerbline.operators import stats
from kerbline.plans.durable import durable
from kerbline.sources.standin import dated, loose, sensors, table

ZONE = "America/New_York"


def _order_times(spark, sf):
    """Local times spread over every hour of the order dates, clock changes included."""
    minute = F.col("o_orderkey") % 1440
    day = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.timestamp_micros(day + minute * 60_000_000).alias("local_ts")
    )


def _typed_loose(spark, sf):
    return c.parse_times(loose(spark, sf), ["ArrivalTime", "DepartureTime"])


def _stream_text(spark, sf):
    text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")
    offset = F.when(F.col("event_id") % 5 == 0, "-05:00").when(F.col("event_id") % 5 == 1, "")
    return sensors(spark, sf).select(
        "event_id", F.concat(text, F.coalesce(offset, F.lit("+00:00"))).alias("event_time")
    )


def _variant_names(spark, sf):
    rows = loose(spark, sf)
    return rows.select(
        "event_id", F.col("DeviceId").alias("device_id"), F.col("BayId").alias("bay_id"),
        F.col("StreetMarker").alias("zone"), F.col("ArrivalTime").alias("Timestamp"),
        F.col("Status").alias("is_occupied"), F.col("DurationMinutes").alias("duration"),
    )


def bronze(spark, sf):
    """Bronze events of the export as stored text, the way a file would hold it."""
    return c.bronze_events(durable(loose(spark, sf)))


def silver(spark, sf):
    rows = sensors(spark, sf).withColumn("status_norm", F.lower("status"))
    return c.silver_base(rows)


QUERIES = {
    "schema_profile": lambda s, d: stats.schema_profile(
        durable(loose(s, d).withColumn("BayText", F.col("BayId").cast("string")))
    ),
    "resolve_columns": lambda s, d: c.resolve_columns(_variant_names(s, d)),
    "parse_ts": lambda s, d: plain(
        _typed_loose(s, d).select("event_id", "ArrivalTime", "DepartureTime")
    ),
    "parse_event_time": lambda s, d: plain(c.parse_event_times(_stream_text(s, d))),
    "to_double": lambda s, d: plain(
        c.to_double(loose(s, d), ["DurationMinutes"]).select("event_id", "DurationMinutes")
    ),
    "duration_min": lambda s, d: plain(
        c.duration_min(_typed_loose(s, d)).select("event_id", "duration_min")
    ),
    "duration_units": lambda s, d: plain(
        c.duration_units(loose(s, d)).select("event_id", "DurationSeconds", "DwellMinutes")
    ),
    "status_from_presence": lambda s, d: c.status_from_presence(_typed_loose(s, d)).select(
        "event_id", "Status"
    ),
    "occupied_flag": lambda s, d: (
        c.occupied_flag(c.occupied_flag(loose(s, d), "Status"), "Status", 0, name="occupied_or_0")
        .select("event_id", "occupied", "occupied_or_0")
    ),
    "event_time": lambda s, d: plain(
        c.event_time(_typed_loose(s, d), "ArrivalTime", "DepartureTime").select(
            "event_id", "event_time"
        )
    ),
    "require_not_null": lambda s, d: plain(
        c.require_not_null(_typed_loose(s, d), ["ArrivalTime", "DurationMinutes"]).select(
            "event_id", "ArrivalTime", "DurationMinutes"
        )
    ),
    "valid_duration": lambda s, d: plain(
        c.valid_duration(sensors(s, d), 5, 120).select("event_id", "duration_min")
    ),
    "round_id": lambda s, d: c.round_id(loose(s, d)).select("event_id", "SignPlateID"),
    "trim_keys": lambda s, d: c.trim_keys(loose(s, d), ["DeviceId", "Status"]).select(
        "event_id", "DeviceId", "Status"
    ),
    "canonical_ids": lambda s, d: c.canonical_ids(
        c.trim_keys(loose(s, d), ["DeviceId", "StreetMarker"]), ["DeviceId", "StreetMarker"]
    ).select("event_id", "DeviceId", "StreetMarker"),
    "localize_utc": lambda s, d: plain(
        c.local_parts(
            c.localize_utc(
                _order_times(s, d).withColumn("utc_ts", F.col("local_ts")), ["utc_ts"], ZONE
            ),
            ZONE,
            "utc_ts",
        )
    ),
    "date_bounds": lambda s, d: plain(
        c.date_bounds(
            sensors(s, d), datetime(2024, 1, 20, 12), datetime(2024, 1, 3)
        ).select("event_id", "event_time")
    ),
    "with_event_date": lambda s, d: c.with_event_date(sensors(s, d)).select("event_id", "event_date"),
    "rename_bronze": lambda s, d: c.rename_bronze(loose(s, d)).select(
        "event_id", "device_id", "street_marker", "sign_plate_id"
    ),
    "keep_columns": lambda s, d: c.keep_columns(
        loose(s, d), ["BayId", "DeviceId", "Sign", "Status", "event_id"]
    ),
    "drop_leaky": lambda s, d: c.drop_leaky(
        loose(s, d).select("event_id", "Status", F.lit(1).alias("_occupied"), "AreaName")
    ),
    "cast_label": lambda s, d: plain(
        c.cast_label(
            c.rename_label(f.target_occupied(dated(s, d))).select("event_id", "label")
        )
    ),
    "apply_filters": lambda s, d: plain(
        c.apply_filters(
            dated(s, d), ["A1", "A2", "A3"], [], ["Mon", "Tue", "Sun"], (7, 18)
        ).select("event_id", "area_name", "street_marker", "dow", "hour", "duration_min")
    ),
    "filter_options": lambda s, d: c.filter_options(dated(s, d), "street_marker"),
    "bronze_events": lambda s, d: plain(
        bronze(s, d).select(
            "event_id", "device_id", "street_marker", "status_norm", "arrive_ts", "depart_ts",
            "event_time", "duration_min", "event_date",
        )
    ),
    "silver_base": lambda s, d: plain(silver(s, d)),
    "to_stream_event": lambda s, d: c.to_stream_event(
        dated(s, d).select(
            F.col("bay_id").alias("DeviceId"),
            F.col("street_marker").alias("StreetMarker"),
            F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("_event_time"),
            F.col("occupied").cast("double").alias("_occupied"),
        )
    ),
    # row-wise features
    "calendar_parts": lambda s, d: f.calendar_parts(sensors(s, d)).select(
        "event_id", "hour", "dow", "dow0", "month", "day_of_month"
    ),
    "is_weekend": lambda s, d: f.is_weekend(sensors(s, d)).select("event_id", "is_weekend"),
    "part_of_day": lambda s, d: f.part_of_day(dated(s, d)).select("event_id", "part_of_day"),
    "day_name": lambda s, d: f.day_name(dated(s, d)).select("event_id", "day_name"),
    "log_duration": lambda s, d: plain(
        f.log_duration(sensors(s, d)).select("event_id", "log_duration_min")
    ),
    "hour_bucket_num": lambda s, d: f.hour_bucket_num(dated(s, d)).select(
        "event_id", "hour_bucket", "is_peak"
    ),
    "hour_bucket_name": lambda s, d: f.hour_bucket_name(dated(s, d)).select(
        "event_id", "hour_bucket"
    ),
    "is_peak": lambda s, d: f.is_peak(dated(s, d)).select("event_id", "is_peak"),
    "interactions": lambda s, d: plain(
        f.interactions(dated(s, d)).select("event_id", "hour_x_weekend", "dow_x_weekend")
    ),
    "cyclic_time": lambda s, d: plain(
        f.cyclic_time(dated(s, d)).select(
            "event_id", "hour_sin", "hour_cos", "dow_sin", "dow_cos"
        )
    ),
    "target_occupied": lambda s, d: f.target_occupied(dated(s, d)).select(
        "event_id", "target_occupied"
    ),
}

SQL = {
    "schema_profile": sql(
        LOOSE,
        "SELECT * FROM (VALUES "
        "(0, 'event_id', 'bigint', 'bigint', "
        "(SELECT count(*) FROM loose)),"
        "(1, 'BayId', 'bigint', 'bigint', "
        "(SELECT count(*) FROM loose)),"
        "(2, 'DeviceId', 'string', 'string', "
        "(SELECT count(*) FROM loose)),"
        "(3, 'StreetMarker', 'string', 'string', "
        "(SELECT count(*) FROM loose)),"
        "(4, 'SignPlateID', 'string', 'double', "
        "(SELECT count(sign_value) FROM loose)),"
        "(5, 'Status', 'string', 'string', "
        "(SELECT count(*) FROM loose)),"
        "(6, 'ArrivalTime', 'string', 'string', "
        "(SELECT count(*) FROM loose)),"
        "(7, 'DepartureTime', 'string', 'string', "
        "(SELECT count(*) FROM loose)),"
        "(8, 'DurationMinutes', 'string', 'string', "
        "(SELECT count(\"DurationMinutes\") FROM loose)),"
        "(9, 'VehiclePresent', 'string', 'string', "
        "(SELECT count(\"VehiclePresent\") FROM loose)),"
        "(10, 'AreaName', 'string', 'string', "
        "(SELECT count(*) FROM loose)),"
        "(11, 'InViolation', 'boolean', 'boolean', "
        "(SELECT count(*) FROM loose)),"
        "(12, 'BayText', 'string', 'bigint', "
        "(SELECT count(*) FROM loose))"
        ') AS t(position, "column", declared, inferred, nonnull)',
    ),
    "resolve_columns": sql(
        LOOSE,
        'SELECT "DeviceId" AS device_id, "StreetMarker" AS street_marker, '
        '"ArrivalTime" AS arrive_ts, "Status" AS status, "DurationMinutes" AS duration_min '
        "FROM loose",
    ),
    "parse_ts": sql(
        LOOSE,
        f"""SELECT event_id, {parsed('"ArrivalTime"')} AS "ArrivalTime",
        {parsed('"DepartureTime"')} AS "DepartureTime" FROM loose""",
    ),
    "parse_event_time": sql(
        SENSORS,
        """SELECT event_id,
        strftime(event_time, '%Y-%m-%d %H:%M:%S')
          || CASE WHEN event_id % 5 = 1 THEN '' ELSE '+00:00' END AS event_time,
        date_trunc('second', event_time) AS event_time_ts
        FROM sensors WHERE event_id % 5 <> 0""",
    ),
    "to_double": sql(
        LOOSE,
        'SELECT event_id, try_cast("DurationMinutes" AS DOUBLE) AS "DurationMinutes" FROM loose',
        ("DurationMinutes",),
    ),
    "duration_min": sql(
        LOOSE,
        f"""SELECT event_id, coalesce(try_cast("DurationMinutes" AS DOUBLE),
        (epoch_us({parsed('"DepartureTime"')}) - epoch_us({parsed('"ArrivalTime"')})) / 6e7)
        AS duration_min FROM loose""",
        ("duration_min",),
    ),
    "duration_units": sql(
        LOOSE,
        'SELECT event_id, try_cast("DurationMinutes" AS DOUBLE) * 60 AS "DurationSeconds", '
        'try_cast("DurationMinutes" AS DOUBLE) AS "DwellMinutes" FROM loose',
        ("DurationSeconds", "DwellMinutes"),
    ),
    "status_from_presence": sql(
        LOOSE,
        f"""SELECT event_id, CASE
          WHEN lower("VehiclePresent") IN ('true', '1', 'yes') THEN 'Present'
          WHEN lower("VehiclePresent") IN ('false', '0', 'no') THEN 'NotPresent'
          WHEN {parsed('"DepartureTime"')} > {parsed('"ArrivalTime"')} THEN 'Present'
          ELSE 'NotPresent' END AS "Status" FROM loose""",
    ),
    "occupied_flag": sql(
        SENSORS,
        """SELECT event_id,
        CASE status WHEN 'Present' THEN 1 WHEN 'NotPresent' THEN 0 END AS occupied,
        CASE status WHEN 'Present' THEN 1 ELSE 0 END AS occupied_or_0 FROM sensors""",
    ),
    "event_time": sql(
        LOOSE,
        f"""SELECT event_id, coalesce({parsed('"ArrivalTime"')}, {parsed('"DepartureTime"')})
        AS event_time FROM loose""",
    ),
    "require_not_null": sql(
        LOOSE,
        f"""SELECT * FROM (SELECT event_id, {parsed('"ArrivalTime"')} AS "ArrivalTime",
        "DurationMinutes" FROM loose)
        WHERE "ArrivalTime" IS NOT NULL AND "DurationMinutes" IS NOT NULL""",
    ),
    "valid_duration": sql(
        SENSORS,
        "SELECT event_id, duration_min FROM sensors WHERE duration_min BETWEEN 5 AND 120",
        ("duration_min",),
    ),
    "round_id": sql(
        SENSORS,
        'SELECT event_id, CAST(CASE WHEN k % 2 = 0 THEN k ELSE k + 1 END AS BIGINT) AS "SignPlateID" '
        "FROM sensors",
    ),
    "trim_keys": sql(
        LOOSE,
        'SELECT event_id, trim("DeviceId") AS "DeviceId", trim("Status") AS "Status" FROM loose',
    ),
    "canonical_ids": sql(
        SENSORS,
        "SELECT event_id, 'D ' || device_id AS \"DeviceId\", "
        "street_marker || ' X' AS \"StreetMarker\" FROM sensors",
    ),
    # New York changed its clocks on the first Sunday of April and the last one of October then.
    "localize_utc": """
        WITH o AS (
          SELECT o_orderkey, o_orderdate + to_minutes(o_orderkey % 1440) AS local_ts,
                 make_timestamp(year(o_orderdate), 4, 1, 0, 0, 0) AS april,
                 make_timestamp(year(o_orderdate), 10, 31, 0, 0, 0) AS october
          FROM orders),
        d AS (
          SELECT o_orderkey, local_ts,
                 april + to_days(CAST((7 - dayofweek(april)) % 7 AS INTEGER)) AS spring,
                 october - to_days(CAST(dayofweek(october) AS INTEGER)) AS autumn
          FROM o),
        u AS (
          SELECT o_orderkey, local_ts, CASE
            WHEN local_ts >= spring + INTERVAL 2 HOUR AND local_ts < spring + INTERVAL 3 HOUR
              THEN spring + INTERVAL 7 HOUR
            WHEN local_ts >= autumn + INTERVAL 1 HOUR AND local_ts < autumn + INTERVAL 2 HOUR
              THEN NULL
            WHEN local_ts >= spring + INTERVAL 3 HOUR AND local_ts < autumn + INTERVAL 1 HOUR
              THEN local_ts + INTERVAL 4 HOUR
            ELSE local_ts + INTERVAL 5 HOUR END AS utc_ts,
            CASE WHEN local_ts >= spring + INTERVAL 2 HOUR AND local_ts < spring + INTERVAL 3 HOUR
              THEN spring + INTERVAL 3 HOUR ELSE local_ts END AS wall
          FROM d)
        SELECT o_orderkey, local_ts, utc_ts,
          CASE WHEN utc_ts IS NOT NULL THEN CAST(hour(wall) AS INTEGER) END AS _hour,
          CASE WHEN utc_ts IS NOT NULL THEN CAST(isodow(wall) - 1 AS INTEGER) END AS _dow,
          CASE WHEN utc_ts IS NULL THEN NULL WHEN isodow(wall) >= 6 THEN 1 ELSE 0 END
            AS _is_weekend
        FROM u""",
    "date_bounds": sql(
        SENSORS,
        "SELECT event_id, event_time FROM sensors WHERE event_time "
        "BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20 12:00:00'",
    ),
    "with_event_date": sql(
        SENSORS, "SELECT event_id, CAST(event_time AS DATE) AS event_date FROM sensors"
    ),
    "rename_bronze": sql(
        LOOSE,
        'SELECT event_id, "DeviceId" AS device_id, "StreetMarker" AS street_marker, '
        "CAST(sign_value AS VARCHAR) AS sign_plate_id FROM loose",
    ),
    "keep_columns": sql(
        LOOSE, 'SELECT "BayId", "DeviceId", "Status", event_id FROM loose'
    ),
    "drop_leaky": sql(LOOSE, 'SELECT event_id, "AreaName" FROM loose'),
    "cast_label": sql(
        DATED, "SELECT event_id, CAST(coalesce(occupied, 0) AS DOUBLE) AS label FROM dated"
    ),
    "apply_filters": sql(
        DATED,
        """SELECT event_id, area_name, street_marker, dow, hour, duration_min FROM dated
        WHERE area_name IN ('A1', 'A2', 'A3') AND dow IN (1, 2, 3) AND hour BETWEEN 7 AND 18""",
        ("duration_min",),
    ),
    "filter_options": sql(
        DATED, "SELECT DISTINCT street_marker FROM dated ORDER BY street_marker"
    ),
    "bronze_events": sql(BRONZE, "SELECT * FROM bronze", ("duration_min",)),
    "silver_base": sql(BASE, "SELECT * FROM base", ("duration_min",)),
    "to_stream_event": sql(
        DATED,
        """SELECT device_id, street_marker,
        strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time, occupied FROM dated""",
    ),
    "calendar_parts": sql(
        DATED,
        """SELECT event_id, hour, dow, dow0, CAST(month(event_time) AS INTEGER) AS month,
        CAST(day(event_time) AS INTEGER) AS day_of_month FROM dated""",
    ),
    "is_weekend": sql(DATED, "SELECT event_id, is_weekend FROM dated"),
    "part_of_day": sql(
        DATED,
        """SELECT event_id, CASE WHEN hour < 6 THEN 'Night' WHEN hour < 12 THEN 'Morning'
        WHEN hour < 17 THEN 'Afternoon' WHEN hour < 22 THEN 'Evening' ELSE 'Night' END
        AS part_of_day FROM dated""",
    ),
    "day_name": sql(DATED, "SELECT event_id, strftime(event_time, '%a') AS day_name FROM dated"),
    "log_duration": sql(
        SENSORS, "SELECT event_id, ln(1 + duration_min) AS log_duration_min FROM sensors",
        ("log_duration_min",),
    ),
    "hour_bucket_num": sql(
        DATED,
        """SELECT event_id,
        CASE WHEN hour IN (7, 8, 9, 10) THEN 1 WHEN hour IN (16, 17, 18, 19) THEN 2 ELSE 0 END
          AS hour_bucket,
        CASE WHEN hour IN (7, 8, 9, 10, 16, 17, 18, 19) THEN 1 ELSE 0 END AS is_peak
        FROM dated""",
    ),
    "hour_bucket_name": sql(
        DATED,
        """SELECT event_id, CASE WHEN hour < 7 OR hour >= 21 THEN 'overnight'
        WHEN hour < 11 THEN 'morning' WHEN hour < 16 THEN 'midday' ELSE 'evening' END
        AS hour_bucket FROM dated""",
    ),
    "is_peak": sql(
        DATED,
        """SELECT event_id, CASE WHEN dow0 <= 4 AND hour >= 8 AND hour <= 18 THEN 1 ELSE 0 END
        AS is_peak FROM dated""",
    ),
    "interactions": sql(
        DATED,
        """SELECT event_id, CAST(hour * is_weekend AS DOUBLE) AS hour_x_weekend,
        CAST(dow * is_weekend AS DOUBLE) AS dow_x_weekend FROM dated""",
    ),
    "cyclic_time": sql(
        DATED,
        """SELECT event_id, sin(2 * pi() * hour / 24) AS hour_sin,
        cos(2 * pi() * hour / 24) AS hour_cos, sin(2 * pi() * dow / 7) AS dow_sin,
        cos(2 * pi() * dow / 7) AS dow_cos FROM dated""",
        ("hour_sin", "hour_cos", "dow_sin", "dow_cos"),
    ),
    "target_occupied": sql(
        DATED, "SELECT event_id, coalesce(occupied, 0) AS target_occupied FROM dated"
    ),
}
