"""Measured sizes that decide between two plans with the same result.

Each limit can be set on the session as `spark.kerbline.<name>`, for instance to fit the executors
or to force the large-data plan in a test.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    # bytes a table may have to be sent whole to every executor
    "broadcastBytes": 8_000_000,
    # rows of one key that a single task may order
    "keyRows": 5_000_000,
    # rows a window frame may span; wider means come from running sums
    "frameRows": 1_000,
    # distinct values the buffer of an exact percentile may hold
    "distinctValues": 500_000,
    # rows of a partition that training keeps in memory
    "partitionRows": 100_000,
    # n-grams of a model that is sent to every task
    "modelRows": 4_000_000,
}


def limit(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(f"spark.kerbline.{name}", str(DEFAULTS[name])))


def heaviest_key(df: DataFrame, by: Sequence[str]) -> int:
    """Rows of the most frequent key. Counts combine before the shuffle, so a hot key is cheap."""
    if not by:
        return df.count()
    heaviest = df.groupBy(*by).count().agg(F.max("count")).first()[0]
    return heaviest or 0


def distinct_estimate(df: DataFrame, column: str) -> int:
    """Number of distinct values within a few per cent, from a fixed-size sketch."""
    return df.agg(F.approx_count_distinct(column)).first()[0]


def table_bytes(df: DataFrame) -> int:
    """Upper estimate of a table's size in memory: 16 bytes a field and the characters of texts."""
    texts = [
        F.length(f"`{f.name}`")
        for f in df.schema.fields
        if f.dataType.typeName() in ("string", "binary")
    ]
    fixed = 16 * len(df.columns)
    width = sum((F.coalesce(4 * t, F.lit(0)) for t in texts), F.lit(fixed))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]
