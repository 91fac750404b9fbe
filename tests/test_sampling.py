"""De-duplication, samples, splits and weights."""

from conftest import rows
from pyspark.sql import functions as F

from kerbline.functions import hashing
from kerbline.operators import sampling as s


def test_dedup_keeps_first_and_matches_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, 5, "b"), (1, None, 3, "a"), (1, 2, 9, "c"), (2, 2, 1, None)],
        "a int, b int, n int, v string",
    )
    out = s.dedup_events(df, ["a", "b"], ["n"])
    assert out.columns == df.columns
    assert sorted(rows(out), key=str) == sorted([(1, None, 3, "a"), (1, 2, 9, "c"), (2, 2, 1, None)], key=str)


def test_balanced_sample(spark, both_plans):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 10 == 0, "few").when(F.col("id") % 50 != 7, "many").alias("c")
    )
    sizes = dict(rows(s.balanced_sample(df, "c", 10_000, "id").groupBy("c").count()))
    assert sizes == {"few": 500, "many": 500}
    small = s.balanced_sample(df, "c", 37, "id")
    assert dict(rows(small.groupBy("c").count())) == {"few": 37, "many": 37}
    again = s.balanced_sample(df.repartition(7), "c", 37, "id")
    assert sorted(rows(small)) == sorted(rows(again))
    other = s.balanced_sample(df, "c", 37, "id", seed=1)
    assert sorted(rows(small)) != sorted(rows(other))
    assert small.columns == df.columns


def test_shuffle_changes_order_only(spark):
    out = [r.id for r in s.shuffle_rows(spark.range(200), "id").collect()]
    assert out != list(range(200)) and sorted(out) == list(range(200))
    assert out == [r.id for r in s.shuffle_rows(spark.range(200).repartition(3), "id").collect()]


def test_time_split(spark, both_plans):
    df = spark.range(1000).withColumn("event_time", F.timestamp_seconds(F.floor(F.col("id") / 2)))
    sizes = dict(rows(s.time_split(df).groupBy("split").count()))
    assert sizes == {"train": 700, "val": 150, "test": 150}
    latest = s.time_split(df).groupBy("split").agg(F.max("id"), F.min("id"))
    edges = {r[0]: r[1:] for r in rows(latest)}
    assert edges["train"][0] < edges["val"][1] and edges["val"][0] < edges["test"][1]


def test_splits_are_disjoint_and_whole(spark):
    df = spark.range(4000).withColumn("label", (F.col("id") % 4 == 0).cast("double"))
    parts = s.parts(s.random_split(df, [6, 3, 1], "id"), 3)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 4000 and 2200 < sizes[0] < 2600 and 280 < sizes[2] < 520
    assert s.union_by_name(parts).distinct().count() == 4000
    train, test = s.parts(s.stratified_split(df, "id"))
    for label, n in rows(train.groupBy("label").count()):
        whole = df.filter(F.col("label") == label).count()
        assert abs(n / whole - 0.7) < 0.05
    assert train.count() + test.count() == 4000


def test_class_weights(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "label double")
    assert dict(rows(s.class_weights(df))) == {1.0: 2.0, 0.0: 4 / 6}
    ones = df.filter("label = 1")
    assert rows(s.class_weights(ones)) == [(1.0, 0.5)]


def test_balanced_sample_by_finer_cells(spark, monkeypatch):
    """Cells cut digit by digit give the rows that a sort by digest gives."""
    df = spark.range(2000).select(
        "id", F.when(F.col("id") % 7 == 0, "a").when(F.col("id") % 7 == 1, "b").when(F.col("id") < 1900, "c").alias("status")
    )
    digests = [(r.status, r.d, r.id) for r in df.select("id", "status", hashing.digest(F.col("id"), 42).alias("d")).collect()]
    monkeypatch.setattr(s, "PREFIX", 1)
    spark.conf.set("spark.kerbline.keyRows", "3")
    try:
        for k in (1, 40, 10_000):
            got = sorted(r.id for r in s.balanced_sample(df, "status", k, "id").collect())
            n = min(k, 286)
            wanted = []
            for status in "abc":
                wanted += [i for _, _, i in sorted(x for x in digests if x[0] == status)[:n]]
            assert got == sorted(wanted)
    finally:
        spark.conf.unset("spark.kerbline.keyRows")
    assert s.balanced_sample(df.filter("false"), "status", 5, "id").count() == 0
