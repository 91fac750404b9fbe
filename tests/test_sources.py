"""Readers and writers on files."""

from conftest import at, rows
from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.operators import cleaning, history
from kerbline.plans.tables import register_views
from kerbline.sources import readers, writers

EVENT_ROWS = [
    "23913,1581S,2019-09-01 08:06:25+00:00,1",
    "23913,1581S,2019-09-01 20:13:22+00:00,1",
    "23913,1581S,2019-09-03 13:30:00+00:00,0",
]


def test_events_csv_with_cr_ends_and_empty_columns(spark, tmp_path):
    header = "DeviceId,StreetMarker,_event_time,_occupied" + "," * 30
    lines = [header] + [r + "," * 30 for r in EVENT_ROWS] + ["," * 33]
    for name, bom in (("plain", b""), ("bom", b"\xef\xbb\xbf")):
        path = tmp_path / f"{name}.csv"
        path.write_bytes(bom + "\r".join(lines).encode())
        df = readers.read_events_csv(spark, str(path)).dropna(subset=["DeviceId"])
        assert df.count() == 3
        events = cleaning.parse_event_times(cleaning.to_stream_event(df))
        assert rows(events.orderBy("event_time_ts"), "device_id", "event_time_ts", "occupied")[0] == (
            "23913", at("2019-09-01 08:06:25"), 1,
        )


def test_events_csv_in_windows_latin(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("DeviceId,StreetMarker,_event_time,_occupied\n1,Caf\xe9,t,0\n".encode("latin-1"))
    df = readers.read_events_csv(spark, str(path), "cp1252")
    assert df.first().StreetMarker == "Café"
    path.write_bytes(b"DeviceId,StreetMarker,_event_time,_occupied\n1,O\x92Hare \x80,t,0\n")
    df = readers.read_events_csv(spark, str(path), "cp1252")
    assert df.first().StreetMarker == "O’Hare €"


def test_json_events_skip_bad_times(spark, tmp_path):
    text = '{"device_id":"1","street_marker":"S","event_time":"%s","occupied":1}\n'
    lines = [text % t for t in ("2019-09-01 08:06:25+00:00", "2019-09-01 08:06:25-05:00", "x")]
    (tmp_path / "events.json").write_text("".join(lines) + "not json\n")
    df = readers.read_events_json(spark, str(tmp_path))
    assert rows(df, "event_time_ts") == [(at("2019-09-01 08:06:25"),)]


def test_loose_csv_keeps_text_and_line_breaks(spark, tmp_path):
    path = tmp_path / "loose.csv"
    path.write_text('a,b\n1,"x ""y""\nz"\n')
    assert rows(readers.read_loose_csv(spark, str(path))) == [("1", 'x "y"\nz')]


def test_raw_csv_by_header_name(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "BayId,Extra,DeviceId,InViolation,ArrivalTime,SignPlateID\n5,zz,9,true,2019-01-01,3.0\n"
    )
    df = readers.read_raw_csv(spark, str(path))
    assert set(df.columns) == {"DeviceId", "ArrivalTime", "SignPlateID", "BayId", "InViolation"}
    assert df.select("BayId", "InViolation", "SignPlateID").first() == (5, True, 3.0)
    assert readers.read_raw_csv(spark, str(path), ["DeviceId", "Sign"]).columns == ["DeviceId"]


def test_parquet_and_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("d", "S1", "3", 1, 5, 2, 0, 1.5)], schemas.ML_READY)
    assert writers.write_parquet(df, str(tmp_path / "p")) == 1
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == rows(df)
    writers.write_csv(df, str(tmp_path / "c"))
    back = readers.read_clean_csv(spark, str(tmp_path / "c"), schemas.ML_READY)
    assert rows(back) == rows(df)


def test_model_outputs(spark, tmp_path):
    path = tmp_path / "importances.csv"
    path.write_text("feature,importance\nHour,0.5\n_dow,0.25\n")
    assert rows(readers.read_importances(spark, str(path))) == [("Hour", 0.5), ("_dow", 0.25)]
    preds = tmp_path / "preds.csv"
    preds.write_text("label,prediction,prob_occupied,Hour,PartOfDay\n1.0,0.0,0.4,5,Night\n")
    row = readers.read_predictions(spark, str(preds)).first()
    assert (row.label, row.prob_occupied, row.Hour, row.PartOfDay) == (1.0, 0.4, 5.0, "Night")
    readers.read_predictions(spark, str(preds)).write.parquet(str(tmp_path / "preds.parquet"))
    assert readers.read_predictions(spark, str(tmp_path / "preds.parquet")).count() == 1


def test_bronze_table_is_partitioned_and_pruned(spark, tmp_path):
    path = str(tmp_path / "bronze")
    days = spark.range(200).select(
        "id", F.expr("date'2024-01-01' + cast(id % 4 as int)").alias("event_date")
    )
    writers.write_bronze(days, path)
    some = readers.read_bronze(spark, path, "2024-01-02", "2024-01-03")
    assert some.count() == 100
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert writers.ensure_bronze(spark, path, "bronze_test").count() == 200
    writers.write_bronze(days.filter("id < 8"), str(tmp_path / "other"))
    assert writers.ensure_bronze(spark, str(tmp_path / "other"), "bronze_test").count() == 200
    writers.register_bronze(spark, str(tmp_path / "other"), "bronze_test")
    assert spark.table("bronze_test").count() == 8
    register_views({"bronze_view": spark.table("bronze_test")})
    assert spark.sql("select count(*) from bronze_view").first()[0] == 8
    spark.sql("drop table bronze_test")


def test_events_json_write(spark, tmp_path):
    df = spark.createDataFrame([("1", "S", "2019-09-01 08:06:25+00:00", 1)], schemas.STREAM_EVENT)
    writers.write_events_json(df, str(tmp_path / "in"))
    writers.write_events_json(df, str(tmp_path / "in"))
    assert readers.read_events_json(spark, str(tmp_path / "in")).count() == 2


def _bronze(spark, days, tag):
    return spark.range(600).select(
        F.concat(F.lit("d"), F.col("id") % 37).alias("device_id"), F.lit("S1").alias("street_marker"),
        F.timestamp_seconds(F.col("id") * 7 + F.lit(1_704_067_200) + (F.col("id") % len(days)) * 86_400).alias("event_time"),
        F.lit("present").alias("status_norm"), F.lit(1.0).alias("duration_min"), F.lit(tag).alias("tag"),
        F.element_at(F.array(*[F.to_date(F.lit(d)) for d in days]), (F.col("id") % len(days) + 1).cast("int")).alias("event_date"),
    )


def test_bronze_replaces_only_the_dates_it_gets(spark, tmp_path):
    path = str(tmp_path / "bronze")
    writers.write_bronze(_bronze(spark, ["2024-01-01", "2024-01-02"], "old"), path)
    writers.write_bronze(_bronze(spark, ["2024-01-02"], "new"), path)
    found = spark.read.parquet(path).groupBy("event_date", "tag").count()
    assert sorted((str(r.event_date), r.tag, r["count"]) for r in found.collect()) == [
        ("2024-01-01", "old", 300), ("2024-01-02", "new", 600),
    ]


def test_bucketed_bronze_gives_history_without_a_shuffle(spark):
    name = "bronze_by_device_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.save_bronze(_bronze(spark, ["2024-01-01", "2024-01-02"], "old"), name, buckets=4)
    writers.save_bronze(_bronze(spark, ["2024-01-02"], "new"), name, buckets=4)
    found = spark.table(name).groupBy("event_date", "tag").count()
    assert sorted((str(r.event_date), r.tag, r["count"]) for r in found.collect()) == [
        ("2024-01-01", "old", 300), ("2024-01-02", "new", 600),
    ]
    base = cleaning.silver_base(spark.table(name))
    out = history.silver_history(base)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan
    assert out.count() == 900
    spark.sql(f"DROP TABLE {name}")


def test_loose_csv_splits_where_no_field_has_breaks(spark, tmp_path):
    plain, broken = tmp_path / "plain.csv", tmp_path / "broken.csv"
    plain.write_text('a,b\n1,"x ""y"" z"\n' + "2,long\n" * 40_000)
    broken.write_text('a,b\n1,"x\ny"\n2,"p ""q\n"" r"\n')
    assert not readers.breaks_in_fields(spark, str(plain)) and readers.breaks_in_fields(spark, str(broken))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        many = readers.read_loose_csv(spark, str(plain))
        assert many.rdd.getNumPartitions() > 1 and many.count() == 40_001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert many.first().b == 'x "y" z'
    assert rows(readers.read_loose_csv(spark, str(broken)), "a", "b") == [("1", "x\ny"), ("2", 'p "q\n" r')]
