"""Column expressions on hand-made edge rows."""

from datetime import timedelta

from conftest import at, rows
from pyspark.sql import functions as F

from kerbline.functions import calendar, hashing, texts, times


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, fn, kind="string"):
    out = column(spark, values, kind).select("i", fn(F.col("v")).alias("r")).orderBy("i")
    return [r.r for r in out.collect()]


def test_parse_ts_formats(spark):
    texts_in = [
        "2019-03-01 08:06:25", "2019-03-01T08:06:25", "03/01/2019 08:06:25",
        "25/12/2019 08:06:25", "2019-03-01 08:06:25+00:00", "2019-03-01 08:06:25-05:00",
        "n/a", "", None,
    ]
    assert apply(spark, texts_in, times.parse_ts) == [
        at("2019-03-01 08:06:25"), at("2019-03-01 08:06:25"), at("2019-03-01 08:06:25"),
        at("2019-12-25 08:06:25"), at("2019-03-01 08:06:25"), at("2019-03-01 13:06:25"),
        None, None, None,
    ]


def test_parse_event_time_cuts_only_plus(spark):
    values = ["2019-09-01 08:06:25+00:00", "2019-09-01 08:06:25", "2019-09-01 08:06:25-05:00", "x", None]
    expected = at("2019-09-01 08:06:25")
    assert apply(spark, values, times.parse_event_time) == [expected, expected, None, None, None]


def test_to_double(spark):
    values = ["12.5", " 7 ", "-1", "1e3", ".5", "abc", "nan", "12d", "", None]
    assert apply(spark, values, texts.to_double) == [
        12.5, 7.0, -1.0, 1000.0, 0.5, None, None, None, None, None,
    ]


def test_round_id_half_to_even(spark):
    assert apply(spark, [0.5, 1.5, 2.5, 7.0, None], texts.round_id, "double") == [0, 2, 2, 7, None]


def test_status_words(spark):
    values = [" Present ", "OCCUPIED", "1", "true", "vacant", "0", "NotPresent", "unknown", None]
    assert apply(spark, values, texts.occupied_flag) == [1, 1, 1, 1, 0, 0, 0, None, None]
    assert apply(spark, values[-2:], lambda c: texts.occupied_flag(c, 0)) == [0, 0]


def test_canonical_id(spark):
    def fn(c):
        return texts.canonical_id(texts.trim_key(c))

    assert apply(spark, ["  a \t b  c ", "x", None], fn) == ["A B C", "X", None]


def test_truth(spark):
    assert apply(spark, ["TRUE", "yes", "0", "No", "maybe", None], texts.truth) == [
        True, True, False, False, None, None,
    ]


def test_to_utc_clock_changes(spark):
    local = [at("2019-03-10 02:30:00"), at("2019-11-03 01:30:00"), at("2019-07-01 12:00:00"),
             at("2019-01-01 12:00:00"), at("2019-03-10 03:00:00"), at("2019-11-03 02:00:00"),
             at("2019-11-03 00:59:59"), None]
    out = apply(spark, local, lambda c: times.to_utc(c, "America/New_York"), "timestamp")
    assert out == [
        at("2019-03-10 07:00:00"), None, at("2019-07-01 16:00:00"), at("2019-01-01 17:00:00"),
        at("2019-03-10 07:00:00"), at("2019-11-03 07:00:00"), at("2019-11-03 04:59:59"), None,
    ]


def test_calendar_numbers(spark):
    start = at("2024-01-07 00:00:00")  # a Sunday
    week = [start + timedelta(days=d) for d in range(7)]
    assert apply(spark, week, calendar.dow, "timestamp") == [1, 2, 3, 4, 5, 6, 7]
    assert apply(spark, week, calendar.dow0, "timestamp") == [6, 0, 1, 2, 3, 4, 5]
    assert apply(spark, week, lambda c: calendar.weekend(calendar.dow(c)), "timestamp") == [
        1, 0, 0, 0, 0, 0, 1,
    ]
    assert apply(spark, [1, 2, 7, 8, None], calendar.day_name, "int") == ["Sun", "Mon", "Sat", None, None]


def test_part_of_day_borders(spark):
    out = apply(spark, [0, 5, 6, 11, 12, 16, 17, 21, 22, 23], calendar.part_of_day, "int")
    assert out == ["Night"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2 + ["Night"] * 2


def test_hour_buckets(spark):
    hours = [6, 7, 10, 11, 15, 16, 19, 20, 21]
    assert apply(spark, hours, calendar.rush_bucket, "int") == [0, 1, 1, 0, 0, 2, 2, 0, 0]
    assert apply(spark, hours, calendar.named_bucket, "int") == [
        "overnight", "morning", "morning", "midday", "midday", "evening", "evening", "evening",
        "overnight",
    ]


def test_fraction_repeats_whatever_the_partitions(spark):
    df = spark.range(1000).select("id", hashing.fraction(F.col("id"), 7).alias("f"))
    again = spark.range(1000).repartition(5).select("id", hashing.fraction(F.col("id"), 7).alias("f"))
    assert sorted(rows(df)) == sorted(rows(again))
    assert df.filter("f < 0 or f >= 1").isEmpty()
    assert 0.45 < df.agg(F.avg("f")).first()[0] < 0.55
