"""Prediction metrics on small tables, ties and absent classes included."""

import random

import pytest
from conftest import rows

from kerbline.operators import metrics as m


def preds(spark, data):
    return spark.createDataFrame(
        [(float(y), float(p), float(s)) for y, p, s in data],
        "label double, prediction double, prob_occupied double",
    )


def brute_auc(data):
    pos = [s for y, _, s in data if y == 1]
    neg = [s for y, _, s in data if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_absent_class(spark):
    df = preds(spark, [(0, 0, 0.1), (0, 1, 0.7)])
    assert rows(m.confusion_matrix(df)) == [
        (0, 0, 1, 0.5), (0, 1, 1, 0.5), (1, 0, 0, None), (1, 1, 0, None),
    ]
    row = m.binary_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall) == (0.5, 0.0, 0.0)
    assert m.kpi_model(df).first().f1_positive == pytest.approx(0)
    assert m.auc(df).first().auc is None


def test_counts_and_f1(spark):
    data = [(1, 1, 0.9)] * 3 + [(1, 0, 0.2)] + [(0, 1, 0.8)] * 2 + [(0, 0, 0.1)] * 4
    df = preds(spark, data)
    assert rows(m.confusion_counts(df)) == [(0.0, 0.0, 4), (0.0, 1.0, 1), (1.0, 0.0, 2), (1.0, 1.0, 3)]
    assert m.kpi_model(df).first().f1_positive == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    f_one, f_zero = 6 / 9, 8 / 11
    assert m.f1_weighted(df).first().f1_weighted == pytest.approx(0.4 * f_one + 0.6 * f_zero)


def test_auc_and_curve_with_ties(spark, both_plans):
    rng = random.Random(3)
    data = [(rng.randrange(2), 0, rng.randrange(12) / 10) for _ in range(300)]
    df = preds(spark, data)
    assert m.auc(df).first().auc == pytest.approx(brute_auc(data))
    full = sorted(rows(m.roc_curve(df, drop_intermediate=False)), reverse=True)
    assert full[0] == (float("inf"), 0.0, 0.0) and full[-1][1:] == (1.0, 1.0)
    assert len(full) == 13
    area = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(full, full[1:], strict=False))
    assert area == pytest.approx(brute_auc(data))


def test_curve_drops_points_on_a_line(spark, both_plans):
    df = preds(spark, [(1, 0, s) for s in (0.9, 0.8, 0.7)] + [(0, 0, s) for s in (0.3, 0.2, 0.1)])
    kept = sorted(rows(m.roc_curve(df), "threshold"), reverse=True)
    assert [t for (t,) in kept] == [float("inf"), 0.9, 0.7, 0.1]
