"""Statistics and reports on edge rows."""

import numpy as np
import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from kerbline.operators import features, reports, stats


def numbers(spark, values, name="duration_min"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def test_constant_column(spark, both_plans):
    df = numbers(spark, [5.0, 5.0, 5.0])
    assert rows(stats.robust_z(df), "duration_min_robust_z") == [(0.0,)] * 3
    assert rows(stats.sigma_outlier(df), "duration_outlier") == [(0,)] * 3
    bins = reports.duration_histogram(df).collect()
    assert [r["count"] for r in bins] == [0] * 25 + [3] + [0] * 24


def test_robust_z_and_winsorize(spark, both_plans):
    values = [float(v) for v in [1, 2, 2, 3, 50, 4, 2]]
    df = numbers(spark, [*values, None])
    med = np.median(values)
    mad = np.median(np.abs(np.array(values) - med))
    got = dict(rows(stats.robust_z(df).dropna(), "duration_min", "duration_min_robust_z"))
    assert got[50.0] == pytest.approx(0.6745 * (50 - med) / mad)
    low, high = np.quantile(values, [0.1, 0.9])
    clipped = dict(rows(stats.winsorize(df, low=0.1, high=0.9)))
    assert clipped[50.0] == pytest.approx(high) and clipped[1.0] == pytest.approx(low)
    assert clipped[None] is None


def test_impute_duration(spark, both_plans):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, None), ("c", 20.0)],
        "street_marker string, duration_min double",
    )
    got = rows(features.impute_duration(df).filter("duration_min is null"), "street_marker", "duration_min_imp")
    assert sorted(got, key=str) == sorted([("a", 2.0), ("b", 3.0), (None, 3.0)], key=str)


def test_lump_rare_and_index(spark, both_plans):
    df = spark.createDataFrame([("a",)] * 3 + [("c",), ("b",), ("b",), ("d",), (None,)], "s string")
    lumped = dict(rows(features.lump_rare(df, "s", 2).distinct(), "s", "s_lumped"))
    assert lumped == {"a": "a", "b": "b", "c": "_OTHER", "d": "_OTHER", None: "_OTHER"}
    index = dict(rows(features.index_categories(df, ["s"]).distinct(), "s", "s_idx"))
    assert index == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0, None: 4.0}
    unseen = features.index_categories(df, ["s"], fit_on=df.filter("s in ('a', 'b')"))
    assert dict(rows(unseen.distinct(), "s", "s_idx"))["c"] == 2.0


def test_street_stats_from_training_rows(spark, both_plans):
    df = spark.createDataFrame(
        [("a", 2.0, 1.0), ("a", 4.0, 0.0), ("b", 1.0, 1.0)],
        "street_marker string, duration_min double, label double",
    )
    fitted = features.street_target_stats(df, fit_on=df.filter("street_marker = 'a'"))
    got = dict(rows(fitted.distinct(), "street_marker", "avg_duration_per_marker"))
    assert got == {"a": 3.0, "b": None}


def test_daily_trend_fills_empty_days(spark):
    df = spark.createDataFrame(
        [(at("2024-01-01 05:00:00"), 1), (at("2024-01-04 05:00:00"), None), (None, 1)],
        "event_time timestamp, occupied int",
    )
    got = [(str(r.day), r.events, r.occ_rate) for r in reports.daily_trend(df).collect()]
    assert got == [
        ("2024-01-01", 1, 1.0), ("2024-01-02", 0, None), ("2024-01-03", 0, None),
        ("2024-01-04", 1, None),
    ]
    assert reports.daily_trend(df.filter("1 = 0")).isEmpty()


def test_heatmap_has_every_day(spark):
    df = spark.createDataFrame([(2, 5, 1), (2, 5, 0)], "dow int, hour int, occupied int")
    got = reports.day_hour_heatmap(df).collect()
    assert [r.day_name for r in got] == ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
    assert got[1].h05 == 0.5 and got[0].h05 is None


def test_null_keys_and_unknown_states(spark):
    df = spark.createDataFrame(
        [("a", 1, 3), ("a", None, 3), (None, 1, None)], "street_marker string, occupied int, hour int"
    )
    assert rows(reports.occ_by_hour(df)) == [(3, 1, 1.0)]
    assert rows(reports.occ_by_street(df)) == [("a", 2, 1.0)]
    assert rows(reports.class_balance(df, "occupied", {0: "Free", 1: "Occupied"})) == [("Occupied", 2, 1.0)]
    assert rows(reports.top_streets(df, min_n=2)) == []
    assert rows(reports.top_streets(df, min_n=1)) == [("a", 1.0, 1)]


def test_histogram_edges(spark):
    df = numbers(spark, [0.0, 5.999, 6.0, 239.0, 240.0, 240.1, -1.0, None])
    got = [r["count"] for r in reports.dwell_histogram(df).collect()]
    assert got[0] == 2 and got[1] == 1 and got[39] == 2 and sum(got) == 5


def test_box_numbers(spark, both_plans):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v, True) for v in values], "duration_min double, in_violation boolean")
    row = reports.dwell_by_violation(df).first()
    assert (row.q1, row.median, row.q3, row.whisker_low, row.whisker_high, row["max"]) == (
        2.0, 3.0, 4.0, 1.0, 4.0, 100.0,
    )


def test_street_cv_without_occupancy(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1), ("b", 0)], "street_marker string, occupied int")
    got = {r.street_marker: r.cv for r in reports.street_cv(df).collect()}
    assert got == {"a": None, "b": 1.414}


def test_anomalies_need_support_and_spread(spark, both_plans):
    data = [("a", 1.0, i) for i in range(30)] + [("a", 90.0, 30), ("b", 1.0, 40), ("b", 99.0, 41)]
    data += [("c", 2.0, 50 + i) for i in range(25)]
    df = spark.createDataFrame(data, "street_marker string, duration_min double, event_id int")
    got = stats.street_anomalies(df).collect()
    assert [(r.street_marker, r.duration_min) for r in got] == [("a", 90.0)]


def test_quality_report_and_profiles(spark):
    df = spark.createDataFrame([(1, "5", None), (2, "x", 1.0), (None, None, -1.0)],
                               "target_occupied int, t string, duration_min double")
    got = {r.check: r.violations for r in stats.quality_report(df, ["label"], ["t", "u"]).collect()}
    assert got == {
        "missing_required_columns": 1, "missing_feature_columns": 1, "null_features": 1,
        "target_not_binary": 2, "negative_duration": 1,
    }
    missing = {r.column: r.missing_pct for r in stats.missing_profile(df).collect()}
    assert missing == {"target_occupied": 33.33, "t": 33.33, "duration_min": 33.33}
    typed = spark.createDataFrame(
        [("1", "1.5", "true", "2024-01-01", "a", None), ("2", "2", "False", "2024-01-02 10:00:00", "1", None)],
        "i string, d string, b string, t string, s string, n string",
    )
    assert [r.inferred for r in stats.schema_profile(typed).collect()] == [
        "bigint", "double", "boolean", "timestamp", "string", "string",
    ]
    assert stats.peek_rows(typed, 1).count() == 1


def test_overview(spark):
    df = spark.range(5).withColumn("x", F.lit(1))
    got = {r.metric: r.value for r in stats.overview(df, df.limit(2)).collect()}
    assert got == {"rows_raw": 5, "rows_clean": 2, "columns_raw": 2}
