"""Folders in any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _place(spark, path)
    return system.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    system, where = _place(spark, path)
    return [item.getPath().getName() for item in system.listStatus(where)] if system.exists(where) else []


def complete(spark: SparkSession, path: str) -> bool:
    """Whether Spark has committed a write to the folder."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    system, where = _place(spark, path)
    system.delete(where, True)
