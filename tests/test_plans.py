"""Sliced windows, running sums and quantiles against brute force, with one hot key."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from kerbline.operators import history
from kerbline.plans.durable import attach
from kerbline.plans.quantiles import quantiles
from kerbline.plans.slices import SEQ, SLICE, ordered_frames, positions, running_sums, slice_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one device, many devices with a row or two, ties in time."""
    rng = random.Random(1)
    data = []
    for i in range(3000):
        device = "hot" if i % 3 == 0 else f"d{rng.randrange(900)}"
        data.append((device, rng.randrange(2000), i, rng.randrange(2), round(rng.random() * 50, 1)))
    return data, spark.createDataFrame(data, "device string, t long, id long, occ int, x double").cache()


def per_device(data):
    groups = defaultdict(list)
    for row in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        groups[row[0]].append(row)
    return groups


def test_hot_key_covers_several_slices(spark, skewed, big_plans):
    _, df = skewed
    sliced = slice_rows(df, ["device", "t", "id"])
    per_slice = rows(sliced.groupBy(SLICE).count())
    assert len(per_slice) == 8
    assert max(n for _, n in per_slice) < 3000 / 3
    assert sliced.filter("device = 'hot'").select(SLICE).distinct().count() > 1
    assert sliced.select(SEQ).distinct().count() == 3000


@pytest.mark.parametrize("before,after", [(9, 0), (0, 2), (3, 3), (700, 0)])
def test_frames_equal_brute_force(skewed, both_plans, before, after):
    data, df = skewed

    def build(w):
        cols = {"n": F.count(F.lit(1)).over(w.rowsBetween(-before, after)),
                "s": F.sum("id").over(w.rowsBetween(-before, after))}
        if before:
            cols["lag"] = F.lag("id", before).over(w)
        if after:
            cols["lead"] = F.lead("id", after).over(w)
        return cols

    out = ordered_frames(df, ["device"], ["t", "id"], build, before=before, after=after)
    got = {r.id: r for r in out.collect()}
    assert len(got) == 3000
    for group in per_device(data).values():
        ids = [r[2] for r in group]
        for i, row_id in enumerate(ids):
            frame = ids[max(0, i - before): i + after + 1]
            assert (got[row_id].n, got[row_id].s) == (len(frame), sum(frame))
            if before:
                assert got[row_id].lag == (ids[i - before] if i >= before else None)
            if after:
                assert got[row_id].lead == (ids[i + after] if i + after < len(ids) else None)


def test_running_sums_within_and_across_keys(skewed, both_plans):
    data, df = skewed
    tally = Counter((r[0], r[1]) for r in data)
    counts = df.groupBy("device", "t").count()
    got = {
        (r.device, r.t): r.upto
        for r in running_sums(counts, ["device"], ["t"], {"upto": F.col("count")}).collect()
    }
    sums, last = {}, None
    for key in sorted(tally):
        total = tally[key] + (sums[last] if last and last[0] == key[0] else 0)
        sums[key], last = total, key
    assert got == sums

    whole = running_sums(df.groupBy("t").count(), [], ["t"], {"upto": F.col("count")})
    assert whole.agg(F.max("upto")).first()[0] == 3000
    by_t = Counter(r[1] for r in data)
    expect, total = {}, 0
    for t in sorted(by_t):
        total += by_t[t]
        expect[t] = total
    assert {r.t: r.upto for r in whole.collect()} == expect


def test_positions(skewed, big_plans):
    data, df = skewed
    order = sorted(data, key=lambda r: (-r[4], r[2]))
    got = {r.id: r.at for r in positions(df, [F.col("x").desc(), "id"], "at").collect()}
    assert got == {row[2]: i for i, row in enumerate(order)}


PROBS = [0.0, 0.001, 0.25, 0.5, 0.7, 0.999, 1.0]


def test_quantiles_of_all(skewed, both_plans):
    data, df = skewed
    got = quantiles(df, "x", PROBS).first().q
    assert got == pytest.approx(np.quantile([r[4] for r in data], PROBS).tolist())


def test_quantiles_by_key(skewed, both_plans):
    data, df = skewed
    groups = defaultdict(list)
    for r in data:
        groups[r[0]].append(r[4])
    got = {r.device: r.q for r in quantiles(df, "x", PROBS, ["device"]).collect()}
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        assert got[key] == pytest.approx(np.quantile(values, PROBS).tolist())


def test_quantiles_skip_null_and_take_empty(spark, both_plans):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert quantiles(df, "x", [0.5]).first().q == [2.0]
    assert quantiles(df.filter("x > 9"), "x", [0.5]).first().q in (None, [None])


def test_quantile_sketch(skewed):
    _, df = skewed
    assert quantiles(df, "x", [0.5], accuracy=10_000).first().q[0] == pytest.approx(25, abs=2)


def test_attach_by_broadcast_or_shuffle(skewed, both_plans):
    data, df = skewed
    joined = attach(df, df.groupBy("device").agg(F.count(F.lit(1)).alias("n")), ["device"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (both_plans == "small")
    sizes = Counter(r[0] for r in data)
    assert {(r.device, r.n) for r in joined.collect()} == set(sizes.items())
    assert joined.count() == 3000


def test_quantiles_keep_null_groups(spark, both_plans):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0), ("b", None)], "k string, v double"
    )
    found = {r.k: r.q for r in quantiles(df, "v", [0.5], ["k"]).collect()}
    assert found == {"a": [2.0], None: [6.0]}


def test_frames_do_not_depend_on_the_plan_under_ties(spark, both_plans):
    tied = spark.createDataFrame(
        [("d", at("2024-01-01T00:00:00"), i % 2, float(i)) for i in range(40)],
        "device_id string, event_time timestamp, occupied int, duration_min double",
    )
    found = history.silver_history(tied.repartition(5)).collect()
    lags = {r.duration_min: r.occ_lag1 for r in found}
    order = sorted(lags, key=lambda v: (v, v % 2))
    assert [lags[v] for v in order] == [None, *[int(v) % 2 for v in order[:-1]]]


def test_percent_rank_keeps_rows_without_time(spark, both_plans):
    df = spark.createDataFrame(
        [(1, at("2024-01-01T00:00:00")), (2, None), (3, at("2024-01-02T00:00:00"))],
        "event_id long, event_time timestamp",
    )
    found = {r.event_id: r.pr for r in history.time_percent_rank(df).collect()}
    assert found == {1: 0.5, 2: 0.0, 3: 1.0}
