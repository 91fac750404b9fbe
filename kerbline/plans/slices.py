"""Ordered work on keys too large for one task.

Spark orders a window group inside one task. Where one key may hold a third of all rows that task
never ends, so the rows are range-partitioned on key and order together: a hot key then covers
several slices of about equal size. Each slice works alone, and a small table with at most a few
rows per slice carries what has to cross a border. The slice numbers come from a sampled range
partitioning, hence they are fixed by a checkpoint before they are used twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kerbline.plans.durable import durable
from kerbline.plans.limits import heaviest_key, limit

SLICE = "_slice"
SEQ = "_seq"
OWNER = "_owner"
GUEST = "_guest"

Order = str | Column


def slice_rows(df: DataFrame, order: Sequence[Order]) -> DataFrame:
    """Rows with `_slice` and `_seq`; `_seq` grows in the global order and has no gap in a slice.

    The order should be total: rows that tie on all of it stay in one slice.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(SEQ, F.monotonically_increasing_id())
    )
    return durable(placed)


def _lend(edge: DataFrame, shifts: tuple[int, int], side: Callable) -> DataFrame:
    """Give each slice its neighbours' edge rows: those at positions first/last + shifts."""
    ranked = edge.withColumn("_rank", F.row_number().over(Window.orderBy(SEQ)))
    wanted = (
        ranked.groupBy(SLICE)
        .agg(side("_rank").alias("_at"))
        .select(
            F.col(SLICE).alias(OWNER),
            F.explode(
                F.sequence(F.col("_at") + F.lit(shifts[0]), F.col("_at") + F.lit(shifts[1]))
            ).alias("_rank"),
        )
    )
    return ranked.join(wanted, "_rank").drop("_rank")


def _guests(rows: DataFrame, before: int, after: int) -> list[DataFrame]:
    """Copies of the rows next to each slice, marked with the slice that borrows them.

    An edge table holds at most `before` or `after` rows per slice, whatever the data size.
    """
    borders = rows.groupBy(SLICE).agg(F.min(SEQ).alias("_lo"), F.max(SEQ).alias("_hi"))
    edged = rows.join(F.broadcast(borders), SLICE)
    lent = []
    if before:
        tails = edged.filter(F.col(SEQ) > F.col("_hi") - before).drop("_lo", "_hi")
        lent.append(_lend(tails, (-before, -1), F.min))
    if after:
        heads = edged.filter(F.col(SEQ) < F.col("_lo") + after).drop("_lo", "_hi")
        lent.append(_lend(heads, (1, after), F.max))
    return [g.withColumn(GUEST, F.lit(True)) for g in lent]


def ordered_frames(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Order],
    build: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add window columns whose frames reach `before` rows back and `after` rows ahead.

    `build` gets the ordered window and returns the columns by name. If no key has more rows than a
    task may order, this is one plain window. Otherwise the slices do the work, each with its
    neighbours' nearest rows as guests.
    """
    if heaviest_key(df, by) <= limit(df.sparkSession, "keyRows"):
        return df.withColumns(build(Window.partitionBy(*by).orderBy(*order)))
    rows = slice_rows(df, [*by, *order])
    served = rows.withColumn(OWNER, F.col(SLICE)).withColumn(GUEST, F.lit(False))
    for guests in _guests(rows, before, after):
        served = served.unionByName(guests)
    spec = Window.partitionBy(OWNER, *by).orderBy(SEQ)
    return (
        served.withColumns(build(spec))
        .filter(~F.col(GUEST))
        .drop(OWNER, GUEST, SLICE, SEQ)
    )


def running_sums(
    df: DataFrame, by: Sequence[str], order: Sequence[Order], sums: dict[str, Column]
) -> DataFrame:
    """Running sums in order within `by`, the row itself included.

    The rows should be aggregated already: one per key and order value, no null key.
    """
    valued = df.withColumns({f"_v_{name}": value for name, value in sums.items()})
    rows = slice_rows(valued, [*by, *order])
    per_slice = rows.groupBy(SLICE, *by).agg(
        *[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in sums]
    )
    # Only a key that began in an earlier slice gets a carry: at most one per slice.
    earlier = (
        Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carries = (
        per_slice.withColumns({f"_c_{n}": F.sum(f"_t_{n}").over(earlier) for n in sums})
        .withColumn("_begun", F.count(F.lit(1)).over(earlier))
        .filter(F.col("_begun") > 0)
        .select(SLICE, *by, *[f"_c_{n}" for n in sums])
    )
    here = (
        Window.partitionBy(SLICE, *by)
        .orderBy(SEQ)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(here) for n in sums})
    joined = local.join(F.broadcast(carries), [SLICE, *by], "left")
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_l_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).alias(n)
            for n in sums
        ],
    )


def positions(df: DataFrame, order: Sequence[Order], name: str) -> DataFrame:
    """Add the row's place in the global order, from 0."""
    rows = slice_rows(df, order)
    sizes = rows.groupBy(SLICE).agg(
        F.count(F.lit(1)).alias("_n"), F.min(SEQ).alias("_lo")
    )
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        SLICE, "_lo", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    return rows.join(F.broadcast(starts), SLICE).select(
        *df.columns, (F.col("_start") + F.col(SEQ) - F.col("_lo")).alias(name)
    )


def next_values(
    df: DataFrame, by: Sequence[str], order: str, values: dict[str, Column], heaviest: int
) -> DataFrame:
    """Add, for each name, the value of the nearest later row of the key whose value is not null.

    Rows have distinct whole numbers `order` within `by`, and values grow with it. `heaviest` is the most
    rows of a key. Up to the limit one window looks back from the end of each key. A larger key covers
    several slices: each slice looks inside itself, and a value from beyond comes from a small table with
    the first values of the later slices of the same key, carried from right to left.
    """
    valued = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    nearest = {n: F.last(f"_v_{n}", ignorenulls=True) for n in values}
    if heaviest <= limit(df.sparkSession, "keyRows"):
        back = Window.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
        return valued.withColumns({n: v.over(back) for n, v in nearest.items()}).select(*df.columns, *values)
    rows = slice_rows(valued, [*by, order])
    # As values grow with the order, the first of the later slices is the least.
    firsts = rows.groupBy(SLICE, *by).agg(*[F.min(f"_v_{n}").alias(f"_f_{n}") for n in values])
    later = Window.partitionBy(*by).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    # Only a key that goes on in a later slice gets a carry: at most one per slice.
    carries = (
        firsts.withColumns({f"_c_{n}": F.min(f"_f_{n}").over(later) for n in values})
        .withColumn("_more", F.count(F.lit(1)).over(later))
        .filter(F.col("_more") > 0)
        .select(SLICE, *by, *[f"_c_{n}" for n in values])
    )
    here = Window.partitionBy(SLICE, *by).orderBy(F.desc(SEQ)).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({f"_l_{n}": v.over(here) for n, v in nearest.items()})
    joined = local.join(F.broadcast(carries), [SLICE, *by], "left")
    return joined.select(*df.columns, *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in values])


KEY = "_key"


def wide_means(
    df: DataFrame, by: Sequence[str], order: Sequence[Order], column: str, name: str, first: int, last: int
) -> DataFrame:
    """Add the mean of `column` over the rows from `first` to `last` before the row (0 is the row itself).

    For frames too wide to walk or to copy: sums and counts run along each key once, and a mean is the
    difference of two of them over that of their counts. Up to the limit for one key they are looked up by
    an offset in one window, beyond that by a join on key and position, so no row is copied to a slice.
    Sums of whole numbers are exact.
    """
    whole = df.schema[column].dataType.typeName() in ("integer", "long", "short", "byte")
    value = F.col(column).cast("long" if whole else "double")
    valued = df.withColumns({"_value": F.coalesce(value, F.lit(0)), "_one": F.col(column).isNotNull().cast("long")})
    if heaviest_key(df, by) <= limit(df.sparkSession, "keyRows"):
        spec = Window.partitionBy(*by).orderBy(*order)
        upto = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = valued.withColumns({"_s": F.sum("_value").over(upto), "_c": F.sum("_one").over(upto)})
        ends = {}
        for end, back in (("_hi", last), ("_lo", first + 1)):
            for part in ("_s", "_c"):
                at = F.lag(part, back).over(spec) if back else F.col(part)
                ends[f"{end}{part}"] = F.coalesce(at, F.lit(0))
        return _mean(summed.withColumns(ends), df.columns, name)
    # A key as text is never null, so rows without a key form a group as in a window.
    keyed = valued.withColumn(KEY, F.to_json(F.struct(*by), {"ignoreNullFields": "false"}))
    rows = durable(
        running_sums(keyed, [KEY], [*by, *order], {"_s": F.col("_value"), "_c": F.col("_one"), "_at": F.lit(1)})
    )
    found = rows
    for end, back in (("_hi", last), ("_lo", first + 1)):
        held = rows.select(
            KEY, (F.col("_at") + back).alias("_at"), F.col("_s").alias(f"{end}_s"), F.col("_c").alias(f"{end}_c")
        )
        found = found.join(held, [KEY, "_at"], "left").fillna(0, [f"{end}_s", f"{end}_c"])
    return _mean(found, df.columns, name)


def _mean(rows: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    known = F.nullif(F.col("_hi_c") - F.col("_lo_c"), F.lit(0))
    return rows.select(*columns, ((F.col("_hi_s") - F.col("_lo_s")) / known).alias(name))
