"""Exact quantiles with linear interpolation, of any number of rows and distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.plans.durable import attach, durable
from kerbline.plans.limits import distinct_estimate, limit
from kerbline.plans.slices import running_sums


KEY = "_key"


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
    distinct: int | None = None,
) -> DataFrame:
    """One row per key (or one row): `by` columns and `q`, an array along `probs`.

    Values are counted first, which shrinks them before the shuffle. Spark's exact percentile holds
    every distinct value of a key in one task: it takes the counts while the measured number of
    values is small. Beyond that they are put in order across the cluster and looked up by rank.
    Rows with a null key form groups like others. `accuracy` asks for the approximate sketch
    instead. `distinct` passes the number on where the caller has measured it.
    """
    number = F.col(value).cast("double").alias("_x")
    known = df.filter(F.col(value).isNotNull()).select(*by, number)
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    if accuracy is not None:
        sketch = F.percentile_approx("_x", [float(p) for p in probs], accuracy)
        return _grouped(known, by).agg(sketch.alias("q"))
    if distinct is None:
        distinct = distinct_estimate(known, "_x")
    counts = known.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_n"))
    if distinct <= limit(df.sparkSession, "distinctValues"):
        return _grouped(counts, by).agg(F.percentile("_x", wanted, F.col("_n")).alias("q"))
    return _by_rank(counts, probs, by)


def count_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """How often each value occurs, per key: `by` columns, `_x`, `_n`; kept, so that it is counted once.

    Every statistic of a column that needs its order can be read off this table: quantiles, the median
    of distances, means. Nulls are left out.
    """
    number = F.col(value).cast("double").alias("_x")
    known = df.filter(F.col(value).isNotNull()).select(*by, number)
    return durable(known.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_n")))


def quantiles_of(counts: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """`quantiles` of counted values. The most values of a key decide between the two plans."""
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    most = counts.groupBy(*by).count().agg(F.max("count")).first()[0] if by else counts.count()
    if (most or 0) <= limit(counts.sparkSession, "distinctValues"):
        return _grouped(counts, by).agg(F.percentile("_x", wanted, F.col("_n")).alias("q"))
    return _by_rank(counts, probs, by)


def quantile_values(counts: DataFrame, probs: Sequence[float]) -> list[float | None]:
    """Quantiles of all counted values as numbers; None where there are no values."""
    found = quantiles_of(counts, probs).first()
    return list(found.q) if found and found.q else [None] * len(probs)


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy()


def _by_rank(counts: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    # A key as text is never null, so groups with nulls in their key stay.
    key = [KEY] if by else []
    keyed = counts.withColumn(KEY, F.to_json(F.struct(*by), {"ignoreNullFields": "false"})) if by else counts
    ranked = durable(running_sums(keyed, key, ["_x"], {"_upto": F.col("_n")}))
    totals = _grouped(ranked, key).agg(F.max("_upto").alias("_all"))
    if by:
        ranked = attach(ranked, totals, key, "inner")
    else:
        ranked = ranked.withColumn("_all", totals.scalar())

    def holds(rank):
        return (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))

    picks = []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("_all") - 1)
        picks += [
            F.max(F.when(holds(F.floor(place)), F.col("_x"))).alias(f"_lo{i}"),
            F.max(F.when(holds(F.ceil(place)), F.col("_x"))).alias(f"_hi{i}"),
            F.max(place - F.floor(place)).alias(f"_f{i}"),
        ]
    found = _grouped(ranked, key).agg(*[F.first(name).alias(name) for name in by], *picks)
    between = [
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")
        for i in range(len(probs))
    ]
    return found.select(*by, F.array(*between).alias("q"))
