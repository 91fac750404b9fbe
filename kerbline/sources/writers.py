"""Sinks. Rows go from the executors to files; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> int:
    """Write over `path`; returns the row count.

    The count comes from the footers of the written files, so the rows are not computed again.
    (An observation during the write would do too, but a session that has one can no longer send
    trained models to its executors.)
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_events_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_bronze(df: DataFrame, path: str) -> None:
    """Table with a folder per event date; only the dates that `df` has are replaced.

    The rebalance hint puts a date into few files and cuts a date too large for one task.
    """
    rows = df.hint("rebalance", "event_date")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def save_bronze(df: DataFrame, name: str = "parking_bronze_by_device", buckets: int = 64) -> None:
    """Catalog table of a folder per date, in buckets by device and sorted by time.

    Rows of a device are then together in every date's bucket of the same number, so what follows a device
    through time reads the table without a shuffle. A later call replaces the dates that `df` has and leaves
    the others. Rows are dealt by date and device first, so that a bucket of a date is one file.
    """
    spark = df.sparkSession
    order = [c for c in ("device_id", "event_time", "event_id") if c in df.columns]
    rows = df.repartition("event_date", F.pmod(F.hash("device_id"), F.lit(buckets)))
    if spark.catalog.tableExists(name):
        setting = "spark.sql.sources.partitionOverwriteMode"  # insertInto takes it from the session only
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            rows.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.set(setting, before)
        return
    rows.write.partitionBy("event_date").bucketBy(buckets, "device_id").sortBy(*order).format("parquet").saveAsTable(name)


def ensure_bronze(spark: SparkSession, path: str, name: str = "parking_bronze") -> DataFrame:
    """Register the bronze folder as a table unless it is one already."""
    if not spark.catalog.tableExists(name):
        register_bronze(spark, path, name)
    return spark.table(name)


def register_bronze(spark: SparkSession, path: str, name: str = "parking_bronze") -> None:
    """(Re)create the table over the folder; the files stay as they are."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
