"""Whole jobs on small tables: reports, weighted training, model comparison, guards, changes on a stream."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kerbline.operators import ml
from kerbline.plans import jobs
from kerbline.streaming import intake

NUMERIC, CATEGORIES = ["Hour", "DwellMinutes"], ["AreaName"]


@pytest.fixture(scope="module")
def clean(spark):
    """Cleaned rows in which the hour decides, but for one in ten."""
    hour, day = (F.col("id") % 24).cast("int"), (F.col("id") % 7).cast("int")
    taken = F.when(F.col("id") % 10 == 3, hour < 12).otherwise(hour >= 12).cast("int")
    return spark.range(960).select(
        F.col("id").alias("row"), hour.alias("Hour"), (F.col("id") % 90).cast("double").alias("DwellMinutes"),
        F.concat(F.lit("A"), F.col("id") % 3).alias("AreaName"), F.concat(F.lit("S"), F.col("id") % 5).alias("StreetMarker"),
        F.col("id").cast("string").alias("DeviceId"),
        F.lit("Present").alias("Status"), (F.col("id") % 8 == 0).alias("InViolation"), taken.alias("target_occupied"),
        taken.alias("_occupied"), hour.alias("_hour"), day.alias("_dow"), (day >= 5).cast("int").alias("_is_weekend"),
        (F.col("id") % 90).cast("double").alias("_duration_min"),
        F.timestamp_seconds(F.col("id") * 3600 + 1_704_067_200).alias("_event_time"),
    ).cache()


def test_compare_saves_every_model(spark, clean, tmp_path):
    few = {
        "logistic": jobs.COMPARED["logistic"],
        "stack": lambda: (ml.stack(ml.random_forest(trees=5, depth=3).setProbabilityCol("rf_prob")), "stack_pred", "stack_raw"),
    }
    found = jobs.compare_models(clean, str(tmp_path), "row", NUMERIC, CATEGORIES, few).collect()
    assert {r.model for r in found} == {"logistic", "stack"}
    assert [r.auc for r in found] == sorted((r.auc for r in found), reverse=True) and all(r.auc > 0.7 for r in found)
    assert len({r.tp + r.fp + r.fn + r.tn for r in found}) == 1
    n = jobs.score_export(clean, str(tmp_path / "models/stack"), str(tmp_path / "s"), ["row"], "stack_pred", "stack_prob")
    scored = spark.read.parquet(str(tmp_path / "s"))
    assert n == scored.count() == 960 and scored.filter("prob_occupied between 0 and 1").count() == 960
    assert spark.read.option("header", True).csv(str(tmp_path / "comparison")).count() == 2


def test_weighted_training(spark, clean, tmp_path):
    ready = clean.select(
        F.col("DeviceId").alias("device_id"), F.col("StreetMarker").alias("street_marker"), "target_occupied",
        F.col("_hour").alias("hour"), (F.col("_dow") + 1).alias("dow"), F.col("_is_weekend").alias("is_weekend"),
        F.col("_duration_min").alias("duration_min"),
    )
    row = jobs.train_weighted(ready, str(tmp_path)).first()
    assert row.auc > 0.7 and row.precision == pytest.approx(row.tp / (row.tp + row.fp))
    preds = spark.read.option("header", True).csv(str(tmp_path / "predictions"))
    assert preds.count() == row.tp + row.fp + row.fn + row.tn
    assert {"device_id", "prob_occupied", "label"} <= set(preds.columns)
    loaded = jobs.PipelineModel.load(str(tmp_path / "model"))
    assert len(loaded.stages) == 4


def test_training_writes_parameters_and_metrics(spark, clean, tmp_path):
    metrics = jobs.train_and_export(clean, str(tmp_path), "row", NUMERIC, CATEGORIES, trees=(3,), depths=(2,)).first()
    best = dict(rows(spark.read.option("header", True).csv(str(tmp_path / "best_params"))))
    assert float(best["numTrees"]) == 3 and float(best["maxDepth"]) == 2
    written = spark.read.option("header", True).csv(str(tmp_path / "metrics")).first()
    assert int(written.tp) == metrics.tp and float(written.auc) == pytest.approx(metrics.auc)


def test_guards(spark, clean, tmp_path):
    with pytest.raises(ValueError, match="missing_required_columns"):
        jobs.train_and_export(clean, str(tmp_path / "a"), "no_such_key", NUMERIC, CATEGORIES)
    bad = clean.withColumn("target_occupied", F.lit(2))
    with pytest.raises(ValueError, match="target_not_binary"):
        jobs.compare_models(bad, str(tmp_path / "b"), "row", NUMERIC, CATEGORIES)
    with pytest.warns(UserWarning, match="Absent"):
        assert jobs.checked(clean, str(tmp_path / "c"), ["row"], ["Hour", "Absent"]) == ["Hour"]
    report = spark.read.option("header", True).csv(str(tmp_path / "c" / "quality"))
    assert dict(rows(report.select("check", "violations")))["missing_feature_columns"] == "1"


def test_reports(spark, clean, tmp_path):
    preds = clean.select(
        F.col("target_occupied").cast("double").alias("label"), (F.col("Hour") >= 12).cast("double").alias("prediction"),
        (F.col("Hour") / 24.0).alias("prob_occupied"),
    )
    found = spark.createDataFrame([("Hour", 0.9), ("DwellMinutes", 0.1)], "feature string, importance double")
    sizes = jobs.write_reports(clean, preds, found, str(tmp_path), areas=["A1"], hours=(6, 20), min_n=1)
    assert sizes["by_hour"] == len([h for h in range(6, 21) if h % 3 == 1]) and sizes["areas"] == 3
    assert sizes["confusion"] == 4 and sizes["day_hour"] == 7 and sizes["importances"] == 2
    kpi = spark.read.parquet(str(tmp_path / "kpis")).first()
    kept = clean.filter("AreaName = 'A1' and Hour between 6 and 20")
    assert kpi.avg_occupancy == pytest.approx(kept.agg(F.avg("_occupied")).first()[0])
    days = spark.read.parquet(str(tmp_path / "by_weekday"))
    assert sorted(rows(days, "dow0", "events")) == sorted(rows(kept.groupBy("_dow").count()))


def test_changes_with_rejects(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [{"device_id": "1", "street_marker": "A", "event_time": f"2024-01-01 10:{m:02d}:00", "occupied": m % 2} for m in range(20)]
    lines += [{"device_id": "1", "street_marker": "A", "event_time": "2024-01-01 20:00:00", "occupied": 1}]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, lines)) + "\nbroken\n")
    taken, query = jobs.stream_changes(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), once=True)
    assert query.awaitTermination(300) and query.exception() is None
    assert intake.events(spark, str(tmp_path / "out/intake")).count() == 21
    assert rows(intake.rejects(spark, str(tmp_path / "out/intake")), "value", "reason") == [("broken", "corrupt")]
