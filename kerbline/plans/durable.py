"""Intermediate results that survive the loss of an executor."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.plans.limits import limit, table_bytes


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which driver and executors share.

    Where the setting is absent, a local session (tests, a notebook) gets a folder of its own; a
    cluster session is refused, as its machines have no folder in common.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kerbline-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Compute once and keep as Parquet in the shared folder, so later reads prune and filter."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(kept: DataFrame) -> DataFrame:
    """A durable table on at least as many partitions as there are cores, for iterative training.

    Training holds its rows in memory, many times as wide as they are stored, and a task reads a whole partition.
    So a partition has at most about `spark.kerbline.partitionRows` rows, and larger input makes more of them.
    Rows are counted where they are: files are split by bytes, but the rows of a row group are all in one split.
    """
    spark = kept.sparkSession
    most, cores = limit(spark, "partitionRows"), spark.sparkContext.defaultParallelism
    found = kept.groupBy(F.spark_partition_id().alias("at")).count()
    filled, fullest, rows = found.agg(F.count(F.lit(1)), F.max("count"), F.sum("count")).first()
    if filled >= cores and fullest <= most:
        return kept
    return kept.repartition(max(cores, -(-(rows or 0) // most)))


def attach(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a table of per-key facts onto rows.

    The facts are computed once and their bytes are measured. Up to the limit they go to every
    executor, so the rows do not move and a hot key does no harm. A larger table is joined by
    shuffle, where the skew-join rule splits hot keys.
    """
    kept = durable(lookup)
    if table_bytes(kept) <= limit(df.sparkSession, "broadcastBytes"):
        kept = F.broadcast(kept)
    return df.join(kept, on, how)
