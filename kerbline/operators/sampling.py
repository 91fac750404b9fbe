"""De-duplication, samples, splits and weights that repeat exactly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions import hashing
from kerbline.functions.times import micros
from kerbline.plans.durable import attach, durable
from kerbline.plans.limits import limit
from kerbline.plans.quantiles import quantiles

# Hexadecimal digits of a digest, and how many of them a histogram of the sample counts: 16**5 cells per class.
DIGITS = 32
PREFIX = 5


def dedup_events(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row by `order` of every key, null keys being equal.

    Written as an aggregate, so copies shrink before the shuffle and a huge group of them never
    meets in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def balanced_sample(
    df: DataFrame, class_col: str, k: int, key: str, seed: int = 42
) -> DataFrame:
    """The same number of rows of every class: `k`, or the size of the smallest class.

    Rows are taken in the order of a digest of `key`, which has to be unique. A histogram of digest
    prefixes tells in which cell each class reaches its number. Cells before it are taken whole. Only the
    rows of that cell are ranked, after it has been cut by further digits if it is large.
    """
    known = df.filter(F.col(class_col).isNotNull())
    marked = known.withColumn("_digest", hashing.digest(F.col(key), seed))
    sizes = known.groupBy(class_col).count()
    wanted = sizes.agg(F.least(F.min("count"), F.lit(k))).first()[0] or 0
    open_cells = sizes.select(class_col, F.lit("").alias("_cell"), F.lit(wanted).cast("long").alias("_open"), "count")
    taken = []
    for begin in range(0, DIGITS, PREFIX):
        if begin and (open_cells.agg(F.max("count")).first()[0] or 0) <= limit(df.sparkSession, "keyRows"):
            break
        before, open_cells = _cells(marked, class_col, open_cells, begin + PREFIX)
        taken.append(before.select(*df.columns))
    inside = _inside(marked, class_col, open_cells)
    place = F.row_number().over(Window.partitionBy(class_col).orderBy("_digest", key))
    last = inside.withColumn("_place", place).filter(F.col("_place") <= F.col("_open"))
    return reduce(DataFrame.unionByName, [*taken, last.select(*df.columns)])


def _inside(marked: DataFrame, class_col: str, cells: DataFrame) -> DataFrame:
    """Rows in the open cell of their class."""
    return attach(marked, cells.drop("count"), [class_col], "inner").filter(F.col("_digest").startswith(F.col("_cell")))


def _cells(marked: DataFrame, class_col: str, cells: DataFrame, digits: int) -> tuple[DataFrame, DataFrame]:
    """Cut each open cell by further digits: the rows of cells taken whole, and the cells that stay open."""
    inside = _inside(marked, class_col, cells).withColumn("_finer", F.substring("_digest", 1, digits))
    counts = inside.groupBy(class_col, "_finer", "_open").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(class_col).orderBy("_finer"))
    last = durable(
        counts.withColumn("_before", upto - F.col("_n"))
        .filter((F.col("_before") < F.col("_open")) & (F.col("_before") + F.col("_n") >= F.col("_open")))
        .select(class_col, F.col("_finer").alias("_cell"), (F.col("_open") - F.col("_before")).alias("_open"), F.col("_n").alias("count"))
    )
    bounds = last.select(class_col, F.col("_cell").alias("_last"))
    return attach(inside, bounds, [class_col], "inner").filter(F.col("_finer") < F.col("_last")), last


def shuffle_rows(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in the order of a digest of `key`."""
    return df.orderBy(hashing.digest(F.col(key), seed), key)


def time_split(
    df: DataFrame,
    cuts: tuple[float, float] = (0.70, 0.85),
    column: str = "event_time",
    accuracy: int | None = None,
) -> DataFrame:
    """Add `split`: train up to the first time quantile, val up to the second, then test."""
    timed = df.withColumn("_us", micros(F.col(column)))
    at = quantiles(timed, "_us", cuts, accuracy=accuracy).select("q").scalar()
    bounded = timed.withColumn("_cuts", at)
    split = (
        F.when(F.col("_us") <= F.col("_cuts")[0], "train")
        .when(F.col("_us") <= F.col("_cuts")[1], "val")
        .when(F.col("_us").isNotNull(), "test")
    )
    return bounded.withColumn("split", split).drop("_us", "_cuts")


def random_split(
    df: DataFrame, weights: Sequence[float], key: str, seed: int = 42
) -> DataFrame:
    """Add `part`, the number of the row's share; shares follow `weights`."""
    total = float(sum(weights))
    at = hashing.bucket(F.col(key), seed)
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        edge = int(hashing.BUCKETS * sum(weights[: i + 1]) / total)
        part = F.when(at < edge, i).otherwise(part)
    return df.withColumn("part", part)


def stratified_split(
    df: DataFrame, key: str, label: str = "label", train: float = 0.7, seed: int = 42
) -> DataFrame:
    """Rows of class 0 and 1 with `part` 0 (train) or 1 (test), each class cut at the same share.

    The digest does not depend on the class, so one pass cuts every class alike.
    """
    return random_split(df.filter(F.col(label).isin(0, 1)), [train, 1 - train], key, seed)


def parts(df: DataFrame, count: int = 2) -> list[DataFrame]:
    """The shares of a split as separate tables."""
    return [df.filter(F.col("part") == i).drop("part") for i in range(count)]


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Add `class_weight`: rows / (2 * rows of the class); an absent class counts as one row."""
    ones, zeros = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    rows = F.count(F.lit(1))

    def weight(size):
        return rows / (2.0 * F.when(size > 0, size).otherwise(1))

    facts = df.agg(F.struct(weight(zeros).alias("w0"), weight(ones).alias("w1"))).scalar()
    weighted = df.withColumn("_w", facts)
    return weighted.withColumn(
        "class_weight", F.when(F.col(label) == 1, F.col("_w.w1")).otherwise(F.col("_w.w0"))
    ).drop("_w")
