"""Descriptive statistics, outliers, profiles and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.functions.texts import NUMBER
from kerbline.plans.durable import attach
from kerbline.plans.quantiles import count_values, quantile_values, quantiles

ROBUST = 0.6745


def describe_duration(df: DataFrame, column: str = "duration_min") -> DataFrame:
    """One row: count, mean, std, min, p50, p90, p95, p99, max; the rows are read once, their values counted."""
    counts = count_values(df, column)
    p50, p90, p95, p99 = (F.lit(v).cast("double") for v in quantile_values(counts, [0.5, 0.9, 0.95, 0.99]))
    mean = counts.agg(F.sum(F.col("_x") * F.col("_n")) / F.sum("_n")).first()[0]
    off = F.col("_x") - F.lit(mean).cast("double")
    n = F.sum("_n")
    return counts.agg(
        F.coalesce(n, F.lit(0)).alias("count"),
        F.lit(mean).cast("double").alias("mean"),
        F.when(n > 1, F.sqrt(F.sum(off * off * F.col("_n")) / (n - 1))).alias("std"),
        F.min("_x").alias("min"),
        p50.alias("p50"), p90.alias("p90"), p95.alias("p95"), p99.alias("p99"),
        F.max("_x").alias("max"),
    )


def extent(df: DataFrame, column: str = "event_time") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(column).alias("min_t"),
        F.max(column).alias("max_t"),
    )


def overview(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Metric and value: raw rows, clean rows, raw columns."""
    width = len(raw.columns)
    counted = raw.agg(F.count(F.lit(1)).alias("value")).select(
        F.explode(
            F.create_map(
                F.lit("rows_raw"), F.col("value"),
                F.lit("columns_raw"), F.lit(width).cast("bigint"),
            )
        ).alias("metric", "value")
    )
    kept = clean.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("rows_clean").alias("metric"), "value"
    )
    return counted.unionByName(kept)


def missing_profile(df: DataFrame) -> DataFrame:
    """Per column: known and missing values and the missing share in per cent, one pass over all."""
    known = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"n_{c}") for c in df.columns]
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("nonnull"))
            for c in df.columns
        ]
    )
    rows = known.select("_rows", F.inline(cells))
    missing = F.col("_rows") - F.col("nonnull")
    share = F.round(100.0 * missing / F.nullif(F.col("_rows"), F.lit(0)), 2)
    return rows.select(
        "column", "nonnull", missing.alias("missing"), share.alias("missing_pct")
    ).orderBy(F.desc("missing_pct"), "column")


def peek_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows, for a look at the data."""
    return df.limit(n)


def schema_profile(df: DataFrame) -> DataFrame:
    """Per column: place, declared type, the narrowest type that all its values fit, known values.

    Reads the whole table once; only text columns are tried for narrower types. Each value gives a
    bit per type it fits, and the bits that all values share remain.
    """
    cells = []
    for i, field in enumerate(df.schema.fields):
        declared = F.lit(field.dataType.simpleString())
        if isinstance(field.dataType, T.StringType):
            shared = F.bit_and(_type_bits(F.col(field.name)))
            inferred = F.lit("string")
            for name in reversed(TEXT_TYPES):
                inferred = F.when(shared.bitwiseAND(TEXT_TYPES[name]) > 0, name).otherwise(inferred)
        else:
            inferred = declared
        cells.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column"),
                declared.alias("declared"),
                inferred.alias("inferred"),
                F.count(field.name).alias("nonnull"),
            )
        )
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


# Types a text may stand for, narrowest first, with the bit of each.
TEXT_TYPES = {"bigint": 1, "double": 2, "boolean": 4, "timestamp": 8}


def _type_bits(text):
    """Bits of the types a text fits; null for null."""
    return (
        F.when(text.rlike(r"^\s*[+-]?[0-9]{1,18}\s*$"), 1 + 2)
        .when(text.rlike(NUMBER), 2)
        .when(F.lower(text).isin("true", "false"), 4)
        .when(text.try_cast("timestamp").isNotNull(), 8)
        .when(text.isNotNull(), 0)
    )


def winsorize(
    df: DataFrame,
    column: str = "duration_min",
    low: float = 0.001,
    high: float = 0.999,
    name: str | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """`<column>_w`: values beyond the two quantiles moved onto them; null stays null."""
    if accuracy is None:
        least, most = quantile_values(count_values(df, column), [low, high])
    else:
        least, most = (quantiles(df, column, [low, high], accuracy=accuracy).first().q or [None, None])
    clipped = F.least(F.greatest(F.col(column), F.lit(least).cast("double")), F.lit(most).cast("double"))
    return df.withColumn(name or f"{column}_w", F.when(F.col(column).isNotNull(), clipped))


def robust_z(df: DataFrame, column: str = "duration_min", name: str | None = None) -> DataFrame:
    """`<column>_robust_z` from the median and the median absolute deviation (0 counts as 1).

    Both come from one table of counted values: the deviations are those of the values, counted alike.
    """
    counts = count_values(df, column)
    (median,) = quantile_values(counts, [0.5])
    middle = F.lit(median).cast("double")
    apart = counts.select(F.abs(F.col("_x") - middle).alias("_x"), "_n").groupBy("_x").agg(F.sum("_n").alias("_n"))
    (mad,) = quantile_values(apart, [0.5])
    return df.withColumn(name or f"{column}_robust_z", ROBUST * (F.col(column) - middle) / F.lit(mad or 1.0))


def sigma_outlier(
    df: DataFrame, column: str = "duration_min", sigmas: float = 3, name: str = "duration_outlier"
) -> DataFrame:
    """0/1: further from the mean than `sigmas` population standard deviations."""
    facts = df.agg(F.struct(F.avg(column).alias("mu"), F.stddev_pop(column).alias("sd"))).scalar()
    off = F.abs(F.col(column) - F.col("_s.mu")) > sigmas * F.col("_s.sd")
    flag = F.coalesce(off, F.lit(False)).cast("int")
    return df.withColumn("_s", facts).withColumn(name, flag).drop("_s")


def street_anomalies(
    df: DataFrame,
    min_n: int = 20,
    z: float = 3,
    k: int | None = 25,
    column: str = "duration_min",
    street: str = "street_marker",
) -> DataFrame:
    """Durations far from their street's mean, farthest above first; `k` None gives all of them."""
    stats = (
        df.filter(F.col(street).isNotNull())
        .groupBy(street)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.avg(column).alias("_mu"),
            F.stddev_pop(column).alias("_sd"),
        )
        .filter((F.col("_n") >= min_n) & (F.col("_sd") > 0))
    )
    score = (F.col(column) - F.col("_mu")) / F.col("_sd")
    far = (
        attach(df, stats, [street], "inner")
        .withColumn("z", score)
        .filter(F.abs("z") > z)
        .drop("_n", "_mu", "_sd")
    )
    ties = [c for c in (street, "event_time", "event_id") if c in df.columns]
    ordered = far.orderBy(F.desc("z"), *ties)
    return ordered if k is None else ordered.limit(k)


def quality_report(
    df: DataFrame,
    required: Sequence[str],
    features: Sequence[str],
    target: str = "target_occupied",
    duration: str = "duration_min",
) -> DataFrame:
    """Check, level and violations: columns present, no null feature, target 0/1, duration >= 0.

    A missing required column is an error, a missing feature a warning. One pass over the rows.
    """
    have = set(df.columns)
    checks = [
        ("missing_required_columns", "error", F.lit(sum(c not in have for c in required))),
        ("missing_feature_columns", "warning", F.lit(sum(c not in have for c in features))),
    ]
    present = [c for c in features if c in have]
    nulls = F.lit(0)
    for c in present:
        nulls = nulls + F.count_if(F.col(c).isNull())
    checks.append(("null_features", "error", nulls))
    if target in have:
        bad = F.col(target).isNull() | ~F.col(target).isin(0, 1)
        checks.append(("target_not_binary", "error", F.count_if(bad)))
    if duration in have:
        checks.append(("negative_duration", "error", F.count_if(F.col(duration) < 0)))
    cells = [
        F.struct(
            F.lit(name).alias("check"), F.lit(level).alias("level"),
            found.cast("bigint").alias("violations"),
        )
        for name, level, found in checks
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))
