"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.plans.durable import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour (or to itself)."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """Node `u` and its component's smallest node `v`, for all nodes with an edge that are not it.

    `edges` has long columns u > v. Alternating large and small stars end in one star per component
    after about log(diameter) rounds. Each round is written to the shared folder. A hub's rows are
    joined to one row of its own, so skewed joins split them; nothing is gathered per node.
    """
    now, before = durable(edges.distinct()), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            return now
        before = mark
        now = durable(_small_star(durable(_large_star(now).distinct())).distinct())
