"""Raw export to sample, cleaned table, model rows; bronze to train-ready."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.operators import cleaning
from kerbline.plans import tables
from kerbline.sources import readers

HIGH = datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """A small export: 6 bays on 3 streets, copies, bad rows."""
    rng = random.Random(5)
    path = tmp_path_factory.mktemp("raw") / "export.csv"
    lines = [",".join(schemas.RAW.fieldNames())]
    for i in range(400):
        bay = rng.randrange(6)
        arrive = datetime(2019, 3, 1) + timedelta(minutes=37 * i)
        stay = rng.randrange(1, 200)
        depart = arrive + timedelta(minutes=stay)
        present = rng.choice(["True", "False", ""])
        lines.append(
            f"{100 + bay},{arrive},{depart},{stay},s{bay % 3}  x,{bay}.0,P1,Area{bay % 2},"
            f"{bay},Street {bay},1,a,2,b,1,N,North,{bay},{stay > 120},{present}"
        )
    lines += lines[1:21]  # copies
    lines.append("1,n/a,n/a,5,s,1.0,P,A,1,S,1,a,2,b,1,N,North,1,True,True")
    lines.append("1,2019-03-01 00:00:00,2019-03-01 00:05:00,-5,s,1.0,P,A,1,S,1,a,2,b,1,N,North,1,True,True")
    path.write_text("\n".join(lines) + "\n")
    return readers.read_raw_csv(spark, str(path))


@pytest.fixture(scope="module")
def sample(raw):
    return tables.sample_table(raw, ["DeviceId"], k=150).cache()


@pytest.fixture(scope="module")
def clean(sample):
    return tables.clean_table(sample, "Australia/Melbourne", HIGH).cache()


def test_sample_is_balanced_and_typed(sample):
    assert sample.columns == schemas.SAMPLE.fieldNames()
    types = dict(sample.dtypes)
    for field in schemas.SAMPLE.fields:
        assert types[field.name] == field.dataType.simpleString(), field.name
    sizes = dict(rows(sample.groupBy("Status").count()))
    assert len(sizes) == 2 and len(set(sizes.values())) == 1
    keys = sample.select("BayId", "ArrivalTime", "DepartureTime")
    assert keys.distinct().count() == sample.count()


def test_clean_table_columns_and_values(spark, sample, clean):
    assert set(clean.columns) == {*schemas.CLEAN.fieldNames(), "rolling_occ_past10"}
    assert clean.count() == sample.count()
    row = clean.orderBy("_event_time").first()
    first = sample.orderBy("ArrivalTime").first()
    # Melbourne is eleven hours ahead in March
    assert row["_event_time"] == first.ArrivalTime - timedelta(hours=11)
    assert row["_hour"] == first.ArrivalTime.hour
    assert row["StreetMarker"].startswith("S") and row["StreetMarker"].endswith(" X")
    assert "  " not in row["StreetMarker"]
    assert row["device_id_lumped"] == row["DeviceId"]
    checks = clean.agg(
        F.count_if(F.col("target_occupied") != (F.col("Status") == "Present").cast("int")),
        F.max("arrivals_N10"), F.min("arrivals_N10"), F.count_if(F.col("_duration_min_imp").isNull()),
        F.count_if(F.abs(F.col("_duration_min") - F.col("DwellMinutes")) > 1e-6),
    ).first()
    assert tuple(checks) == (0, 10, 1, 0, 0)


def test_clean_table_from_large_plans(clean, sample, big_plans):
    again = tables.clean_table(sample, "Australia/Melbourne", HIGH).select(clean.columns)
    assert sorted(rows(again), key=str) == sorted(rows(clean), key=str)


def test_model_tables(clean):
    narrow = tables.ml_ready(clean)
    assert narrow.columns == schemas.ML_READY.fieldNames()
    wide = tables.model_rows(clean, schemas.NUMERIC_FEATURES, schemas.CATEGORY_FEATURES)
    assert {"label", *schemas.NUMERIC_FEATURES, *schemas.CATEGORY_FEATURES} <= set(wide.columns)
    assert not set(schemas.LEAKY) & set(wide.columns)
    assert wide.count() == clean.count()
    fewer = tables.model_rows(clean.drop("AreaName"), schemas.NUMERIC_FEATURES, schemas.CATEGORY_FEATURES)
    assert "AreaName" not in fewer.columns


def test_silver_tables(spark):
    data = [
        ("7", "S1", f"2024-01-01 10:{m:02d}:00", "present" if m % 2 else "absent") for m in range(0, 50, 7)
    ]
    raw = spark.createDataFrame(data, "DeviceId string, StreetMarker string, ArrivalTime string, Status string")
    loose = raw.withColumns(
        {"DepartureTime": F.lit("2024-01-01 12:00:00"), "SignPlateID": F.lit("1"),
         "DurationMinutes": F.lit("5")}
    )
    made = tables.silver_tables(cleaning.bronze_events(loose))
    tables.register_views(made)
    ready = spark.table("train_ready")
    assert ready.count() == 7
    assert ready.agg(F.min("pr"), F.max("pr")).first() == (0.0, 1.0)
    assert spark.table("silver_base").first().event_time >= at("2024-01-01 10:00:00")
    assert spark.table("label_next").count() == 8
