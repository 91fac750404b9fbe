"""Cleaning operators on hand-made edge rows."""

import os
import time
from datetime import datetime

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from kerbline.operators import cleaning as c


def test_find_and_resolve_columns(spark):
    df = spark.createDataFrame([(1, 2, "x")], "bay_id int, device_id int, `zone` string")
    assert c.find_columns(df) == {"device_id": "device_id", "street_marker": "zone"}
    assert c.resolve_columns(df).columns == ["device_id", "street_marker"]


def test_strip_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, b int")
    assert c.strip_headers(df).columns == ["a", "b"]


DURATIONS = [
    ("12.5", "1", "60", "2024-01-01 00:00:00", "2024-01-01 01:00:00", 12.5),
    ("abc", "7", "60", None, None, 7.0),
    (None, None, "90", None, None, 1.5),
    (None, None, None, "2024-01-01 00:00:00.900", "2024-01-01 00:01:30.100", 1.5),
    (None, None, "x", "2024-01-01 00:00:00", None, None),
]


def test_duration_takes_the_first_number(spark):
    df = spark.createDataFrame(
        [(i, *d[:5]) for i, d in enumerate(DURATIONS)],
        "i int, DurationMinutes string, DwellMinutes string, DurationSeconds string, a string, d string",
    ).withColumns({"ArrivalTime": F.to_timestamp("a"), "DepartureTime": F.to_timestamp("d")})
    out = c.duration_min(df).orderBy("i").select("duration_min")
    assert [r[0] for r in out.collect()] == [d[5] for d in DURATIONS]
    only_times = c.duration_min(df.drop("DurationMinutes", "DwellMinutes", "DurationSeconds"))
    assert rows(only_times.orderBy("i"), "duration_min")[0] == (60.0,)
    assert rows(c.duration_min(spark.range(1)), "duration_min") == [(None,)]


def test_status_from_presence(spark):
    data = [("TRUE", None, None, "Present"), ("no", 1, 2, "NotPresent"), (None, 1, 2, "Present"),
            ("maybe", 2, 1, "NotPresent"), (None, None, 2, "NotPresent")]
    df = spark.createDataFrame([d[:3] for d in data], "VehiclePresent string, a long, d long").select(
        "VehiclePresent", F.timestamp_seconds("a").alias("ArrivalTime"),
        F.timestamp_seconds("d").alias("DepartureTime"),
    )
    assert [r.Status for r in c.status_from_presence(df).collect()] == [d[3] for d in data]


def test_status_from_boolean_column(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "VehiclePresent boolean").withColumns(
        {"ArrivalTime": F.timestamp_seconds(F.lit(1)), "DepartureTime": F.timestamp_seconds(F.lit(5))}
    )
    out = [r.Status for r in c.status_from_presence(df).collect()]
    assert out == ["Present", "NotPresent", "Present"]


def test_occupied_without_status_uses_duration(spark):
    df = spark.createDataFrame([(2.0,), (0.0,), (None,)], "duration_min double")
    assert rows(c.occupied_flag(df), "occupied") == [(1,), (0,), (0,)]


def test_event_time_fills_the_missing_side(spark):
    one = spark.createDataFrame([(at("2024-01-01 00:00:00"),)], "depart_ts timestamp")
    row = c.event_time(one).first()
    assert row.arrive_ts == row.depart_ts == row.event_time
    both = spark.createDataFrame(
        [(None, at("2024-01-02 00:00:00"))], "arrive_ts timestamp, depart_ts timestamp"
    )
    assert c.event_time(both).first().event_time == at("2024-01-02 00:00:00")
    with pytest.raises(ValueError):
        c.event_time(spark.range(1))


def test_valid_duration_edges(spark):
    df = spark.createDataFrame(
        [(0.0,), (1440.0,), (1440.01,), (-0.1,), (None,)], "duration_min double"
    )
    assert rows(c.valid_duration(df)) == [(0.0,), (1440.0,)]
    assert len(rows(c.valid_duration(df, high=None))) == 3


def test_date_bounds_are_inclusive(spark):
    days = ["1999-12-31", "2000-01-01", "2024-01-02", "2024-01-03"]
    df = spark.createDataFrame([(at(d),) for d in days], "event_time timestamp")
    assert c.date_bounds(df, datetime(2024, 1, 2)).count() == 2


def test_apply_filters(spark):
    df = spark.createDataFrame(
        [("A1", "S1", 1, 5), ("A1", "S2", 2, 9), ("A2", "S1", 7, 23)],
        "area_name string, street_marker string, dow int, hour int",
    )
    assert c.apply_filters(df).count() == 3
    assert c.apply_filters(df, areas=["A1"], days=["Mon"]).count() == 1
    assert c.apply_filters(df, streets=["S1"], hours=(6, 23)).count() == 1
    assert rows(c.filter_options(df, "street_marker")) == [("S1",), ("S2",)]
    assert c.apply_filters(df.drop("area_name"), areas=["A1"]).count() == 3


def test_bronze_events(spark):
    raw = spark.createDataFrame(
        [
            ("7", "S1", "3", " Present ", "2024-01-01 10:00:00", "2024-01-01 10:30:00", None),
            ("7", "S1", "3", "Absent", "01/02/2024 10:00:00", "n/a", "5"),
            ("8", "S1", "3", "x", "n/a", "n/a", "5"),
            ("8", "S1", "3", "x", "2024-01-01 10:00:00", "2024-01-03 10:30:00", None),
            ("9", "S2", None, None, "n/a", "2024-01-05 10:00:00", "-1"),
        ],
        "DeviceId string, StreetMarker string, SignPlateID string, Status string, "
        "ArrivalTime string, DepartureTime string, DurationMinutes string",
    )
    out = c.bronze_events(raw)
    assert {"device_id", "street_marker", "sign_plate_id", "event_date"} <= set(out.columns)
    got = rows(out.orderBy("event_time"), "device_id", "status_norm", "duration_min", "event_time")
    assert got == [
        ("7", "present", 30.0, at("2024-01-01 10:00:00")),
        ("7", "absent", 5.0, at("2024-01-02 10:00:00")),
    ]
    silver = rows(c.silver_base(out).orderBy("event_time"), "occupied", "hour", "dow", "is_weekend")
    assert silver == [(1, 10, 2, 0), (0, 10, 3, 0)]


def test_to_stream_event_needs_its_columns(spark):
    good = spark.createDataFrame(
        [(1, "S", "2024-01-01 00:00:00+00:00", "1")],
        "DeviceId int, StreetMarker string, _event_time string, _occupied string",
    )
    assert rows(c.to_stream_event(good)) == [("1", "S", "2024-01-01 00:00:00+00:00", 1)]
    with pytest.raises(Exception, match="_occupied"):
        c.to_stream_event(good.drop("_occupied"))


def test_label_columns(spark):
    df = spark.createDataFrame([(1, "x", 1, None)], "target_occupied int, Status string, _occupied int, z int")
    out = c.cast_label(c.drop_leaky(c.rename_label(df)))
    assert out.columns == ["label", "z"] and out.first().label == 1.0
    with pytest.raises(ValueError):
        c.rename_label(df.drop("target_occupied"))
    assert c.require_not_null(out, ["z"]).isEmpty()


def test_date_bounds_do_not_depend_on_the_process_zone(spark):
    df = spark.sql("SELECT TIMESTAMP'2000-01-01 00:00:00' AS event_time")
    before = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        assert c.date_bounds(df, datetime(2001, 1, 1)).count() == 1
    finally:
        if before is None:
            os.environ.pop("TZ")
        else:
            os.environ["TZ"] = before
        time.tzset()
