"""Whole tables: raw rows to balanced sample, cleaned table, model rows; bronze to train-ready."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions import calendar, texts, times
from kerbline.operators import cleaning, features, history, sampling, stats
from kerbline.plans.durable import durable
from kerbline.schemas import CLEAN, SAMPLE


def normalised(raw: DataFrame, order: list[str]) -> DataFrame:
    """Raw sensor rows typed, filtered, with calendar features and without copies.

    `order` says which of several rows of one bay, arrival and departure stays; all other columns
    break ties, so the choice is repeatable.
    """
    timed = cleaning.parse_times(raw, ["ArrivalTime", "DepartureTime"])
    measured = cleaning.duration_units(timed, "DurationMinutes")
    known = cleaning.require_not_null(
        cleaning.status_from_presence(measured),
        ["BayId", "ArrivalTime", "DepartureTime", "DurationSeconds"],
    )
    kept = cleaning.valid_duration(known, high=None, column="DurationSeconds")
    when = F.col("ArrivalTime")
    day = calendar.dow(when)
    rich = cleaning.round_id(kept, "SignPlateID").withColumns(
        {
            "Hour": F.hour(when),
            "DayOfWeek": day,
            "IsWeekend": day.isin(1, 7),
            "Month": F.month(when),
            "DayOfMonth": F.dayofmonth(when),
            "PartOfDay": calendar.part_of_day(F.hour(when)),
        }
    )
    keys = ["BayId", "ArrivalTime", "DepartureTime"]
    rest = sorted(set(rich.columns) - set(keys) - set(order))
    return sampling.dedup_events(rich, keys, [*order, *rest])


def all_rows(raw: DataFrame, order: list[str]) -> DataFrame:
    """All normalised rows, in the order of the sample schema."""
    return cleaning.keep_columns(normalised(raw, order), SAMPLE.fieldNames())


def sample_rows(rows: DataFrame, k: int = 7_500, seed: int = 42) -> DataFrame:
    """Balanced sample by status of stored normalised rows: up to `k` of each."""
    keyed = rows.withColumn(
        "_key", F.concat_ws("|", "BayId", F.unix_micros("ArrivalTime"), F.unix_micros("DepartureTime"))
    )
    return cleaning.keep_columns(
        sampling.balanced_sample(keyed, "Status", k, "_key", seed), SAMPLE.fieldNames()
    )


def sample_table(raw: DataFrame, order: list[str], k: int = 7_500, seed: int = 42) -> DataFrame:
    """Balanced sample by status of raw rows; the sample reads the normalised rows three times."""
    return sample_rows(durable(all_rows(raw, order)), k, seed)


def clean_table(sample: DataFrame, zone: str, high: datetime) -> DataFrame:
    """Cleaned table with every derived column, from rows in local time of `zone`.

    `high` bounds plausible times (UTC). Each step that needs facts of all rows reads them once.
    """
    found = cleaning.find_columns(sample)
    arrive = found.get("arrive_ts", "_arrive_dt")
    depart = found.get("depart_ts", "_depart_dt")
    device, street = found["device_id"], found["street_marker"]
    rows = sample
    for ours, theirs in ((arrive, depart), (depart, arrive)):
        if ours not in rows.columns:
            rows = rows.withColumn(ours, F.col(theirs))
    apart = (times.micros(F.col(depart)) - times.micros(F.col(arrive))) / 60e6
    given = [texts.to_double(F.col(found["duration_min"]))] if "duration_min" in found else []
    rows = rows.withColumn("_duration_min", F.coalesce(*given, apart))
    rows = cleaning.occupied_flag(
        rows, found.get("status", ""), duration="_duration_min", name="_occupied"
    )
    rows = cleaning.require_not_null(rows, [arrive, depart, "_duration_min"])
    rows = cleaning.valid_duration(rows, column="_duration_min")
    rows = stats.sigma_outlier(rows, "_duration_min", name="_duration_outlier")

    keys = [c for c in (device, street, found.get("sign_plate_id"), found.get("status")) if c]
    rows = cleaning.canonical_ids(cleaning.trim_keys(rows, keys), [device, street])
    rest = [c for c in sample.columns if c not in keys and c not in (arrive, depart)]
    rows = sampling.dedup_events(rows, [*keys, arrive, depart], rest or [arrive])
    rows = cleaning.localize_utc(rows, [arrive, depart], zone)
    rows = cleaning.local_parts(rows.withColumn("_event_time", F.col(arrive)), zone, "_event_time")
    rows = durable(cleaning.date_bounds(rows, high, column="_event_time"))

    rows = stats.winsorize(rows, "_duration_min")
    rows = stats.robust_z(rows, "_duration_min", "_duration_robust_z")
    rows = features.lump_rare(rows, street, 50, "street_marker_lumped")
    rows = features.lump_rare(rows, device, 20, "device_id_lumped")
    rows = features.impute_duration(rows, "_duration_min", street).withColumnRenamed(
        "duration_min_imp", "_duration_min_imp"
    )
    rows = features.target_occupied(rows, "_occupied").withColumn(
        "_occupied_imp", F.col("target_occupied")
    )
    order = ["_event_time", depart, *[c for c in ("BayId",) if c in rows.columns]]
    rows = history.rolling_occ(rows, 10, by=[device], order=order)
    # Training must not see the row's own state.
    rows = history.rolling_occ(rows, 10, by=[device], order=order, past_only=True)
    return history.arrivals_n(rows, 10, by=[device], order=order)


def ml_ready(clean: DataFrame) -> DataFrame:
    """Narrow model table of the cleaned one."""
    found = cleaning.find_columns(clean)
    ids = ("device_id", "street_marker", "sign_plate_id")
    return clean.select(
        *[F.col(found[name]).cast("string").alias(name) for name in ids if name in found],
        "target_occupied",
        F.col("_hour").alias("hour"),
        F.col("_dow").alias("dow"),
        F.col("_is_weekend").alias("is_weekend"),
        F.col("_duration_min").alias("duration_min"),
    )


def model_rows(clean: DataFrame, numeric: list[str], categories: list[str]) -> DataFrame:
    """Cleaned rows as the model takes them: label as double, no leaks, no null in a feature.

    Features the table lacks are left out; `stats.quality_report` lists them.
    """
    labelled = cleaning.drop_leaky(cleaning.rename_label(clean))
    if "rolling_occ_past10" in labelled.columns:
        # A device's first event has no past; it stays, as likely occupied as not.
        labelled = labelled.fillna(0.5, ["rolling_occ_past10"])
    wanted = ["label", *[c for c in [*numeric, *categories] if c in labelled.columns]]
    return cleaning.cast_label(cleaning.require_not_null(labelled, wanted))


def silver_tables(bronze: DataFrame, minutes: int = 15) -> dict[str, DataFrame]:
    """Silver base, history, priors, label and train-ready tables by name; the base is kept once."""
    base = durable(cleaning.silver_base(bronze))
    past = history.silver_history(base)
    priors = history.silver_priors(past, base)
    labels = history.label_next_window(base, minutes)
    return {
        "silver_base": base,
        "silver_history": past,
        "silver_priors": priors,
        "label_next": labels,
        "train_ready": history.train_ready(priors, labels),
    }


def register_views(tables: dict[str, DataFrame]) -> None:
    """Tables by name for SQL users."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


CLEAN_COLUMNS = CLEAN.fieldNames()
