"""Shared pieces of the registered queries: the stand-in rows in SQL and the output form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone and doubles to six digits, so that two engines can agree on them."""
    shown = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            value = F.round(value, DIGITS) + F.lit(0.0)
        shown.append(value.alias(field.name))
    return df.select(*shown)


SENSORS = """
sensors AS (
  SELECT event_id, user_id AS bay_id, CAST(user_id AS VARCHAR) AS device_id, k,
         'S' || k AS street_marker, 'A' || (k % 10) AS area_name,
         ts AS arrive_ts,
         make_timestamp(epoch_us(ts) + CAST(round(value * 6e7) AS BIGINT)) AS depart_ts,
         ts AS event_time, value AS duration_min,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'Present'
              WHEN event_type IN ('view', 'signup') THEN 'NotPresent'
              ELSE 'unknown' END AS status,
         value > 150 AS in_violation
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

DATED = f"""{SENSORS},
dated AS (
  SELECT *,
         CASE status WHEN 'Present' THEN 1 WHEN 'NotPresent' THEN 0 END AS occupied,
         CAST(extract(hour FROM event_time) AS INTEGER) AS hour,
         CAST(dayofweek(event_time) + 1 AS INTEGER) AS dow,
         CAST(isodow(event_time) - 1 AS INTEGER) AS dow0,
         CASE WHEN isodow(event_time) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM sensors
)"""


def _text(ts: str) -> str:
    return f"""CASE WHEN event_id % 97 = 0 THEN 'n/a'
              WHEN event_id % 4 = 0 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S')
              WHEN event_id % 4 = 1 THEN strftime({ts}, '%m/%d/%Y %H:%M:%S')
              WHEN event_id % 4 = 2 THEN strftime({ts}, '%d/%m/%Y %H:%M:%S')
              ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S') END"""


LOOSE = f"""{SENSORS},
loose AS (
  SELECT event_id, bay_id AS "BayId", ' d  ' || device_id || ' ' AS "DeviceId",
         lower(street_marker) || '  x' AS "StreetMarker",
         CAST(k + 0.5 AS DOUBLE) AS sign_value,
         ' ' || upper(status) AS "Status", status,
         {_text('arrive_ts')} AS "ArrivalTime",
         {_text('depart_ts')} AS "DepartureTime",
         CASE WHEN event_id % 11 = 0 THEN 'abc'
              WHEN event_id % 7 <> 0 THEN CAST(duration_min AS VARCHAR) END AS "DurationMinutes",
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN status = 'Present' THEN 'TRUE'
              WHEN status = 'NotPresent' THEN 'no' ELSE 'maybe' END AS "VehiclePresent",
         area_name AS "AreaName", in_violation AS "InViolation"
  FROM sensors
)"""


def parsed(column: str) -> str:
    formats = ("%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%d/%m/%Y %H:%M:%S")
    tries = ", ".join(f"try_strptime({column}, '{f}')" for f in formats)
    return f"coalesce({tries})"


BRONZE = f"""{LOOSE},
timed AS (
  SELECT *, {parsed('"ArrivalTime"')} AS arrive_ts, {parsed('"DepartureTime"')} AS depart_ts
  FROM loose
),
bronze AS (
  SELECT * FROM (
    SELECT event_id, "DeviceId" AS device_id, "StreetMarker" AS street_marker,
           lower(trim("Status")) AS status_norm, arrive_ts, depart_ts,
           coalesce(arrive_ts, depart_ts) AS event_time,
           CAST(coalesce(arrive_ts, depart_ts) AS DATE) AS event_date,
           coalesce(try_cast("DurationMinutes" AS DOUBLE),
                    (epoch_us(depart_ts) - epoch_us(arrive_ts)) / 6e7) AS duration_min
    FROM timed)
  WHERE event_time IS NOT NULL AND duration_min BETWEEN 0 AND 1440
)"""

BASE = f"""{DATED},
base AS (
  SELECT event_id, device_id, street_marker, event_time, lower(status) AS status_norm,
         coalesce(occupied, 0) AS occupied, duration_min, hour, dow, is_weekend
  FROM dated WHERE duration_min BETWEEN 0 AND 1440
)"""

PREDS = f"""{DATED},
preds AS (
  SELECT event_id, CAST(coalesce(occupied, 0) AS DOUBLE) AS label,
         CASE WHEN event_id * 7919 % 1000 >= 500 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
         (event_id * 7919 % 1000) / 1000.0::DOUBLE AS prob_occupied
  FROM dated
)"""


def sql(tables: str, body: str, doubles: tuple[str, ...] = ()) -> str:
    """A query over stand-in tables, its double columns rounded as `plain` does."""
    inner = f"WITH {tables.strip()}\n{body.strip()}"
    if not doubles:
        return inner
    swaps = ", ".join(f'round("{c}", {DIGITS}) + 0.0 AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({swaps}) FROM (\n{inner}\n)"
