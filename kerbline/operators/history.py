"""Looking back and ahead along the events of a device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.functions.times import micros
from kerbline.plans.durable import attach, durable
from kerbline.plans.limits import heaviest_key, limit
from kerbline.plans.slices import next_values, ordered_frames, running_sums, wide_means

BY = ("device_id",)
ORDER = ("event_time", "event_id")


def _order(df: DataFrame, order: Sequence[str]) -> list[str]:
    """A total order: the order columns the table has, then all others in order of names.

    Rows that still tie are equal, so the values of a frame do not depend on the plan.
    """
    given = [c for c in order if c in df.columns]
    sortable = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]
    return [*given, *sorted(set(sortable) - set(given))]


def silver_history(
    base: DataFrame, by: Sequence[str] = BY, order: Sequence[str] = ORDER, past: int = 9
) -> DataFrame:
    """Last two states and the means over the `past` events before the row."""

    def build(w):
        back = w.rowsBetween(-past, -1)
        return {
            "occ_lag1": F.lag("occupied", 1).over(w),
            "occ_lag2": F.lag("occupied", 2).over(w),
            "occ_roll10_past": F.avg("occupied").over(back),
            "dur_roll10_past": F.avg("duration_min").over(back),
        }

    return ordered_frames(base, by, _order(base, order), build, before=max(past, 2))


def rolling_occ(
    df: DataFrame,
    n: int = 10,
    column: str = "target_occupied",
    by: Sequence[str] = BY,
    order: Sequence[str] = ORDER,
    past_only: bool = False,
) -> DataFrame:
    """Mean over the last `n` events: with the row itself for reports, before it for training.

    A frame wider than the limit comes from running sums, any other from a window.
    """
    first, last = (-n, -1) if past_only else (1 - n, 0)
    name = f"rolling_occ_past{n}" if past_only else f"rolling_occ_N{n}"
    if n > limit(df.sparkSession, "frameRows"):
        return wide_means(df, by, _order(df, order), column, name, -first, -last)

    def build(w):
        return {name: F.avg(column).over(w.rowsBetween(first, last))}

    return ordered_frames(df, by, _order(df, order), build, before=n)


def arrivals_n(
    df: DataFrame, n: int = 10, by: Sequence[str] = BY, order: Sequence[str] = ORDER
) -> DataFrame:
    """Events of the device among its last `n`, the row included: the running position up to `n`."""
    if n > limit(df.sparkSession, "frameRows") and heaviest_key(df, by) > limit(df.sparkSession, "keyRows"):
        keyed = df.withColumn("_key", F.to_json(F.struct(*by), {"ignoreNullFields": "false"}))
        placed = running_sums(keyed, ["_key"], [*by, *_order(df, order)], {"_at": F.lit(1)})
        return placed.select(*df.columns, F.least("_at", F.lit(n)).cast("int").alias(f"arrivals_N{n}"))

    def build(w):
        seen = F.count(F.lit(1)).over(w.rowsBetween(1 - n, 0))
        return {f"arrivals_N{n}": seen.cast("int")}

    return ordered_frames(df, by, _order(df, order), build, before=n - 1)


def label_next_event(
    base: DataFrame, by: Sequence[str] = BY, order: Sequence[str] = ORDER
) -> DataFrame:
    """`occ_next`: state at the next event of the device, null at its last."""

    def build(w):
        return {"occ_next": F.lead("occupied", 1).over(w)}

    return ordered_frames(base, by, _order(base, order), build, after=1)


def label_next_window(base: DataFrame, minutes: int = 15) -> DataFrame:
    """Per device and time: was any event in the next `minutes` occupied; null if no state was known then.

    Replaces a range self-join. Times are first made distinct. Each then looks up the next time with a
    known state and the next occupied time of its device, and compares both with the horizon. So no row
    is copied, and a busy device spreads over slices with one carried row each.
    """
    horizon = minutes * 60 * 1_000_000
    timed = base.filter(F.col("device_id").isNotNull() & F.col("event_time").isNotNull())
    instants = (
        timed.groupBy("device_id", "event_time")
        .agg(F.max("occupied").alias("_occ"))
        .withColumn("_us", micros(F.col("event_time")))
    )
    ahead = {
        "_known": F.when(F.col("_occ").isNotNull(), F.col("_us")),
        "_taken": F.when(F.col("_occ") > 0, F.col("_us")),
    }
    until = F.col("_us") + F.lit(horizon)
    state = F.when(F.col("_taken") <= until, 1).when(F.col("_known") <= until, 0)
    return next_values(instants, BY, "_us", ahead, heaviest_key(timed, BY)).select(
        "device_id", "event_time", state.alias("occ_in_next")
    )


def street_priors(base: DataFrame) -> DataFrame:
    """Occupancy rate and rows per street, hour and weekday."""
    return base.groupBy("street_marker", "hour", "dow").agg(
        F.avg("occupied").alias("street_hour_dow_occ_prior"),
        F.count(F.lit(1)).alias("n"),
    )


def silver_priors(history: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Prior of the row's street, hour and weekday, fitted on `base` or the rows themselves."""
    priors = street_priors(history if base is None else base).drop("n")
    return attach(history, priors, ["street_marker", "hour", "dow"])


def time_percent_rank(df: DataFrame, column: str = "event_time", name: str = "pr") -> DataFrame:
    """Place of each row in time from 0 to 1, equal times equal, over all rows.

    Equal to a global PERCENT_RANK with nulls first, without its single task: the distinct times are
    counted, put in order across the cluster and joined back. Rows without a time come first.
    """
    timed = df.filter(F.col(column).isNotNull())
    untimed = df.filter(F.col(column).isNull())
    counts = timed.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sums(counts, [], [column], {"_upto": F.col("_n")})
    last = df.agg(F.count(F.lit(1)) - 1).scalar()
    first = df.agg(F.count_if(F.col(column).isNull())).scalar()
    place = F.col("_upto") - F.col("_n") + first
    placed = ranked.select(
        column, F.coalesce(place / F.nullif(last, F.lit(0)), F.lit(0.0)).alias(name)
    )
    ranks = timed.join(placed, column).select(*df.columns, name)
    return ranks.unionByName(untimed.withColumn(name, F.lit(0.0)))


def train_ready(priors: DataFrame, labels: DataFrame, prior_default: float = 0.5) -> DataFrame:
    """Rows with a label and their place in time; a street without a prior gets the default."""
    labelled = labels.filter(F.col("occ_in_next").isNotNull())
    rows = priors.join(labelled, ["device_id", "event_time"]).select(
        *[c for c in ("event_id",) if c in priors.columns],
        "device_id",
        "street_marker",
        "event_time",
        "hour",
        "dow",
        "is_weekend",
        "duration_min",
        "occ_lag1",
        "occ_lag2",
        "occ_roll10_past",
        "dur_roll10_past",
        F.coalesce("street_hour_dow_occ_prior", F.lit(prior_default)).alias(
            "street_hour_dow_occ_prior"
        ),
        F.col("occ_in_next").alias("label"),
    )
    # the rank reads the rows three times
    return time_percent_rank(durable(rows))
