"""Device history and labels on small fixtures, with both plans."""

import random
from datetime import timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from kerbline.operators import history as h

START = at("2024-01-01 00:00:00")


def events(spark, spec):
    """Rows of (device, seconds after the start, occupied, duration)."""
    data = [
        (i, d, "S1", START + timedelta(microseconds=round(s * 1e6)), o, float(m))
        for i, (d, s, o, m) in enumerate(spec)
    ]
    return spark.createDataFrame(
        data,
        "event_id long, device_id string, street_marker string, event_time timestamp, "
        "occupied int, duration_min double",
    ).withColumns({"hour": F.hour("event_time"), "dow": F.dayofweek("event_time"),
                   "is_weekend": F.lit(0)})


def two_devices(spark):
    """Two devices of 12 events each, one tie in time, and a device with a single event."""
    spec = [(d, 60 * i, i % 2, i) for d in ("a", "b") for i in range(12)]
    spec[12] = ("b", 60, 0, 0)  # b: its first event moves onto the second one
    return events(spark, [*spec, ("c", 0, 1, 9)])


def test_silver_history(spark, both_plans):
    got = {r.event_id: r for r in h.silver_history(two_devices(spark)).collect()}
    assert len(got) == 25
    assert (got[0].occ_lag1, got[0].occ_lag2, got[0].occ_roll10_past) == (None, None, None)
    assert (got[1].occ_lag1, got[1].occ_lag2) == (0, None)
    # nine rows back at most: events 2 to 10 for the last event of device a
    assert got[11].occ_roll10_past == 4 / 9
    assert got[11].dur_roll10_past == sum(range(2, 11)) / 9
    # the tie is broken by event_id
    assert (got[12].occ_lag1, got[13].occ_lag1) == (None, 0)
    assert got[24].occ_lag1 is None


def test_rolling_and_arrivals(spark, both_plans):
    df = two_devices(spark).withColumn("target_occupied", F.col("occupied"))
    out = h.arrivals_n(h.rolling_occ(h.rolling_occ(df), past_only=True))
    got = {r.event_id: r for r in out.collect()}
    assert [got[i].arrivals_N10 for i in range(12)] == [*range(1, 11), 10, 10]
    assert got[24].arrivals_N10 == 1
    assert got[0].rolling_occ_N10 == 0 and got[0].rolling_occ_past10 is None
    assert got[11].rolling_occ_N10 == 0.5
    assert got[11].rolling_occ_past10 == 0.5
    assert got[24].rolling_occ_N10 == 1


def test_label_next_event(spark, both_plans):
    got = dict(rows(h.label_next_event(two_devices(spark)), "event_id", "occ_next"))
    assert got[0] == 1 and got[1] == 0 and got[11] is None and got[24] is None


@pytest.mark.parametrize("minutes", [1, 15, 24 * 60])
def test_label_window_with_a_hot_device(spark, both_plans, minutes):
    """A third of the rows on one device, unknown states, times that repeat, devices across slices."""
    pick = random.Random(minutes)
    spec = [
        ("hot" if i % 3 == 0 else f"d{pick.randrange(60)}", pick.randrange(0, 40_000), pick.choice([0, 0, 0, 1, None]), 1)
        for i in range(1500)
    ]
    states = {}
    for device, second, state, _ in spec:
        known = [v for v in (states.get((device, second)), state) if v is not None]
        states[device, second] = max(known, default=None)
    wanted = {}
    for device, second in states:
        ahead = [
            v for (d, s), v in states.items()
            if d == device and second < s <= second + 60 * minutes and v is not None
        ]
        wanted[device, second] = max(ahead, default=None)
    out = h.label_next_window(events(spark, spec), minutes)
    got = {(r.device_id, (r.event_time - START).total_seconds()): r.occ_in_next for r in out.collect()}
    assert got == wanted


def test_label_window_sends_no_row_twice(spark, both_plans):
    plan = h.label_next_window(two_devices(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan


def test_label_window_edges(spark, both_plans):
    quarter = 15 * 60
    spec = [
        ("same", 0, 0, 1), ("same", 0, 1, 1),
        ("exact", 0, 0, 1), ("exact", quarter, 1, 1),
        ("over", 0, 0, 1), ("over", quarter + 1e-6, 1, 1),
        ("none", 0, 1, 1),
        ("any", 10, 0, 1), ("any", 20, 0, 1), ("any", quarter, 1, 1), ("any", quarter + 15, 0, 1),
    ]
    out = h.label_next_window(events(spark, spec))
    got = {(r.device_id, (r.event_time - START).total_seconds()): r.occ_in_next for r in out.collect()}
    assert got == {
        ("same", 0): None,
        ("exact", 0): 1, ("exact", quarter): None,
        ("over", 0): None, ("over", quarter + 1e-6): None,
        ("none", 0): None,
        ("any", 10): 1, ("any", 20): 1, ("any", quarter): 0, ("any", quarter + 15): None,
    }


def test_label_window_before_the_epoch(spark):
    df = events(spark, [("a", 0, 0, 1), ("a", 30, 1, 1)]).withColumn(
        "event_time", F.expr("event_time - interval 80 years")
    )
    assert sorted(r.occ_in_next or 0 for r in h.label_next_window(df).collect()) == [0, 1]


def test_train_ready(spark, both_plans):
    base = events(spark, [("a", 60 * i, i % 2, i) for i in range(4)] + [("z", 0, 1, 1)])
    base = base.withColumn("street_marker", F.when(F.col("event_id") != 2, F.col("street_marker")))
    priors = h.silver_priors(h.silver_history(base), base)
    out = h.train_ready(priors, h.label_next_window(base)).orderBy("event_time")
    got = rows(out, "event_id", "label", "pr", "street_hour_dow_occ_prior")
    assert got == [(0, 1, 0.0, 0.75), (1, 1, 0.5, 0.75), (2, 1, 1.0, 0.5)]


def test_percent_rank_of_ties_and_single_row(spark, both_plans):
    df = events(spark, [("a", s, 0, 1) for s in (0, 5, 5, 9)])
    assert sorted(r.pr for r in h.time_percent_rank(df).collect()) == [0.0, 1 / 3, 1 / 3, 1.0]
    assert rows(h.time_percent_rank(df.limit(1)), "pr") == [(0.0,)]


@pytest.mark.parametrize("past_only", [False, True])
def test_very_wide_frames(spark, both_plans, past_only):
    """Frames wider than the data, and than a few rows, from running sums; nulls and rows without device."""
    pick = random.Random(5)
    spec = [(pick.choice(["hot", "hot", "a", "b", None]), pick.randrange(300), pick.choice([0, 1, None]), i) for i in range(900)]
    df = events(spark, spec).withColumn("target_occupied", F.col("occupied"))
    held = {}
    for i, (device, second, state, _) in enumerate(spec):
        held.setdefault(device, []).append((second, i, state))
    for n in (1_001, 10**6):
        rolled = h.arrivals_n(h.rolling_occ(df, n, past_only=past_only), n)
        got = {r.event_id: r for r in rolled.collect()}
        assert len(got) == len(spec)
        for group in held.values():
            group.sort()
            for at, (_, i, _) in enumerate(group):
                frame = group[max(0, at - n) : at] if past_only else group[max(0, at + 1 - n) : at + 1]
                known = [s for _, _, s in frame if s is not None]
                name = f"rolling_occ_past{n}" if past_only else f"rolling_occ_N{n}"
                assert got[i][name] == (sum(known) / len(known) if known else None)
                assert got[i][f"arrivals_N{n}"] == min(at + 1, n)


def test_wide_frames_equal_narrow_ones(spark, both_plans):
    df = two_devices(spark).withColumn("target_occupied", F.col("occupied"))
    for past_only in (False, True):
        narrow = sorted(map(str, h.rolling_occ(df, 3, past_only=past_only).collect()))
        spark.conf.set("spark.kerbline.frameRows", "2")
        try:
            wide = sorted(map(str, h.rolling_occ(df, 3, past_only=past_only).collect()))
            doubles = h.rolling_occ(df, 3, column="duration_min", past_only=past_only).count()
        finally:
            spark.conf.unset("spark.kerbline.frameRows")
        assert wide == narrow and doubles == 25
