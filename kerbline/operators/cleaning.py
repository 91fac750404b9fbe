"""Cleaning of sensor rows: projections, predicates, normalisation.

Every operator takes and gives a DataFrame and adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions import calendar, texts, times
from kerbline.schemas import LEAKY

DAY_MINUTES = 24 * 60

# Column names the exports use for one thing, best first.
NAME_VARIANTS = {
    "device_id": ["DeviceId", "device_id", "bay_id"],
    "street_marker": ["StreetMarker", "street_marker", "zone", "street"],
    "sign_plate_id": ["SignPlateID", "sign_plate_id"],
    "arrive_ts": ["ArrivalTime", "arrival_time", "Arrival", "arrival", "Timestamp",
                  "timestamp", "_arrive_dt"],
    "depart_ts": ["DepartureTime", "departure_time", "Departure", "departure", "_depart_dt"],
    "status": ["Status", "status", "_status", "occupied", "is_occupied", "_status_bin"],
    "duration_min": ["DurationMinutes", "duration_minutes", "Duration", "duration",
                     "_duration_min"],
}

# Names the reports look for, best first.
REPORT_VARIANTS = {
    "hour": ["Hour", "_hour"],
    "dow": ["DayOfWeek"],
    "in_violation": ["InViolation"],
    "dwell_minutes": ["DwellMinutes", "_duration_min"],
    "occupied": ["target_occupied", "_occupied"],
    "street_marker": ["StreetMarker", "street_marker_lumped", "street_marker"],
    "area_name": ["AreaName"],
}

BRONZE_NAMES = {
    "DeviceId": "device_id",
    "StreetMarker": "street_marker",
    "SignPlateID": "sign_plate_id",
}


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def find_columns(
    df: DataFrame, variants: Mapping[str, Sequence[str]] = NAME_VARIANTS
) -> dict[str, str]:
    """Canonical name to the first variant that the table has; absent ones are left out."""
    have = set(df.columns)
    found = {}
    for name, options in variants.items():
        hit = next((option for option in options if option in have), None)
        if hit is not None:
            found[name] = hit
    return found


def resolve_columns(
    df: DataFrame, variants: Mapping[str, Sequence[str]] = NAME_VARIANTS
) -> DataFrame:
    """The resolvable columns under their canonical names."""
    found = find_columns(df, variants)
    return df.select(*[F.col(source).alias(name) for name, source in found.items()])


def parse_times(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to timestamps; text in no known format becomes null."""
    return df.withColumns({c: times.parse_ts(F.col(c)) for c in columns})


def parse_event_times(df: DataFrame, source: str = "event_time") -> DataFrame:
    """Stream time text to `event_time_ts`; rows whose text does not fit are skipped."""
    parsed = df.withColumn("event_time_ts", times.parse_event_time(F.col(source)))
    return parsed.filter(F.col("event_time_ts").isNotNull())


def to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: texts.to_double(F.col(c)) for c in columns})


def duration_min(
    df: DataFrame, arrive: str = "ArrivalTime", depart: str = "DepartureTime"
) -> DataFrame:
    """`duration_min` from whichever duration column holds a number, else from the two times.

    The times are cut to whole seconds before they are subtracted. Works row by row.
    """
    choices = []
    for name in ("DurationMinutes", "DwellMinutes"):
        if name in df.columns:
            choices.append(texts.to_double(F.col(name)))
    if "DurationSeconds" in df.columns:
        choices.append(texts.to_double(F.col("DurationSeconds")) / 60.0)
    if arrive in df.columns and depart in df.columns:
        choices.append(times.seconds_between(F.col(depart), F.col(arrive)) / 60.0)
    value = F.coalesce(*choices) if choices else F.lit(None)
    return df.withColumn("duration_min", value.cast("double"))


def duration_units(df: DataFrame, source: str = "DurationMinutes") -> DataFrame:
    """Minutes in text to `DurationSeconds` and back to `DwellMinutes`."""
    seconds = texts.to_double(F.col(source)) * 60.0
    return df.withColumns({"DurationSeconds": seconds, "DwellMinutes": seconds / 60.0})


def status_from_presence(
    df: DataFrame,
    presence: str = "VehiclePresent",
    arrive: str = "ArrivalTime",
    depart: str = "DepartureTime",
) -> DataFrame:
    """`Status` Present or NotPresent; without a usable flag the departure must be later."""
    seen = F.coalesce(
        texts.truth(F.col(presence)), F.col(depart) > F.col(arrive), F.lit(False)
    )
    return df.withColumn("Status", F.when(seen, "Present").otherwise("NotPresent"))


def occupied_flag(
    df: DataFrame,
    status: str = "status",
    unknown: int | None = None,
    duration: str = "duration_min",
    name: str = "occupied",
) -> DataFrame:
    """Status words to 1/0; without a status column a positive duration counts as occupied."""
    if status in df.columns:
        value = texts.occupied_flag(F.col(status), unknown)
    else:
        value = (F.coalesce(F.col(duration), F.lit(0.0)) > 0).cast("int")
    return df.withColumn(name, value)


def event_time(df: DataFrame, arrive: str = "arrive_ts", depart: str = "depart_ts") -> DataFrame:
    """`event_time` is the arrival, else the departure; a missing column is filled by the other."""
    both = [c for c in (arrive, depart) if c in df.columns]
    if not both:
        raise ValueError(f"neither {arrive} nor {depart} in {df.columns}")
    return df.withColumns(
        {
            arrive: F.col(arrive) if arrive in both else F.col(depart),
            depart: F.col(depart) if depart in both else F.col(arrive),
            "event_time": F.coalesce(*[F.col(c) for c in both]),
        }
    )


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def valid_duration(
    df: DataFrame, low: float = 0, high: float | None = DAY_MINUTES, column: str = "duration_min"
) -> DataFrame:
    """Keep durations of at least `low` and, if given, at most `high`."""
    kept = F.col(column) >= low
    if high is not None:
        kept = kept & (F.col(column) <= high)
    return df.filter(kept)


def round_id(df: DataFrame, column: str = "SignPlateID") -> DataFrame:
    return df.withColumn(column, texts.round_id(F.col(column)))


def trim_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: texts.trim_key(F.col(c)) for c in columns})


def canonical_ids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: texts.canonical_id(F.col(c)) for c in columns})


def localize_utc(df: DataFrame, columns: Sequence[str], zone: str) -> DataFrame:
    """Local times of `zone` to UTC: first valid instant in a gap, null where it is ambiguous."""
    return df.withColumns({c: times.to_utc(F.col(c), zone) for c in columns})


def local_parts(df: DataFrame, zone: str, column: str = "event_time") -> DataFrame:
    """`_hour`, `_dow` (0 = Monday) and `_is_weekend` of a UTC time on the wall clock of a zone."""
    wall = times.in_zone(F.col(column), zone)
    return df.withColumns(
        {
            "_hour": F.hour(wall),
            "_dow": calendar.dow0(wall),
            "_is_weekend": calendar.weekend(calendar.dow(wall)),
        }
    )


def date_bounds(
    df: DataFrame,
    high: datetime,
    low: datetime = datetime(2000, 1, 1),
    column: str = "event_time",
) -> DataFrame:
    """Keep plausible times. The caller passes the upper bound, normally tomorrow.

    Bounds without a zone are UTC, whatever the zone of the driver's process.
    """
    low, high = (t if t.tzinfo else t.replace(tzinfo=UTC) for t in (low, high))
    return df.filter(F.col(column).between(F.lit(low), F.lit(high)))


def with_event_date(df: DataFrame, column: str = "event_time") -> DataFrame:
    return df.withColumn("event_date", F.to_date(column))


def rename_bronze(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(BRONZE_NAMES)


def rename_label(df: DataFrame, source: str = "target_occupied") -> DataFrame:
    if source not in df.columns:
        raise ValueError(f"label column {source} is missing")
    return df.withColumnRenamed(source, "label")


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in the listed order, as far as the table has them."""
    return df.select(*[c for c in columns if c in df.columns])


def drop_leaky(df: DataFrame, columns: Sequence[str] = LEAKY) -> DataFrame:
    return df.drop(*columns)


def cast_label(df: DataFrame, column: str = "label") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


def apply_filters(
    df: DataFrame,
    areas: Sequence[str] | None = None,
    streets: Sequence[str] | None = None,
    days: Sequence[str] | None = None,
    hours: tuple[int, int] = (0, 23),
) -> DataFrame:
    """A user's choice of areas, streets, weekday names and hours; an empty list filters nothing."""
    for column, chosen in (("area_name", areas), ("street_marker", streets)):
        if chosen and column in df.columns:
            df = df.filter(F.col(column).isin(list(chosen)))
    if days:
        df = df.filter(calendar.day_name(F.col("dow")).isin(list(days)))
    return df.filter(F.col("hour").between(*hours))


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """What a user can choose from: sorted distinct values without null."""
    return df.select(column).dropna().distinct().orderBy(column)


def bronze_events(raw: DataFrame) -> DataFrame:
    """Loose text rows to typed events: times, duration, status words, date, canonical names."""
    parsed = parse_times(raw, ["ArrivalTime", "DepartureTime"])
    timed = duration_min(parsed).withColumns(
        {
            "status_norm": texts.status_norm(F.col("Status")),
            "arrive_ts": F.col("ArrivalTime"),
            "depart_ts": F.col("DepartureTime"),
        }
    )
    kept = valid_duration(require_not_null(event_time(timed), ["event_time"]))
    return rename_bronze(with_event_date(kept))


def silver_base(bronze: DataFrame) -> DataFrame:
    """Model-side columns of the bronze events. `event_id`, where there is one, breaks ties in time."""
    kept = valid_duration(require_not_null(bronze, ["event_time"]))
    when = F.col("event_time")
    return kept.select(
        *[c for c in ("event_id",) if c in bronze.columns],
        "device_id",
        "street_marker",
        when,
        texts.status_norm(F.col("status_norm")).alias("status_norm"),
        (F.coalesce(texts.occupied_flag(F.col("status_norm")), F.lit(0))).alias("occupied"),
        "duration_min",
        F.hour(when).alias("hour"),
        calendar.dow(when).alias("dow"),
        calendar.weekend(calendar.dow(when)).alias("is_weekend"),
    )


def to_stream_event(df: DataFrame) -> DataFrame:
    """Clean rows as stream events; a missing column fails when the plan is analysed."""
    return df.select(
        F.col("DeviceId").cast("string").alias("device_id"),
        F.col("StreetMarker").alias("street_marker"),
        F.col("_event_time").cast("string").alias("event_time"),
        F.col("_occupied").cast("int").alias("occupied"),
    )
