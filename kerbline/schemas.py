"""Explicit schemas, so that no scan has to infer one."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """`name type, name type`; works before there is a session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# The columns of the sensor export.
RAW = _schema(
    "DeviceId bigint, ArrivalTime string, DepartureTime string, DurationMinutes string, "
    "StreetMarker string, SignPlateID double, Sign string, AreaName string, "
    "StreetId bigint, StreetName string, BetweenStreet1ID bigint, BetweenStreet1 string, "
    "BetweenStreet2ID bigint, BetweenStreet2 string, SideOfStreet bigint, "
    "SideOfStreetCode string, SideName string, BayId bigint, "
    "InViolation boolean, VehiclePresent boolean"
)

# The columns of the balanced sample, in order.
SAMPLE = _schema(
    "BayId bigint, DeviceId bigint, StreetMarker string, StreetName string, Sign string, "
    "Status string, ArrivalTime timestamp, DepartureTime timestamp, DurationSeconds double, "
    "Hour int, DayOfWeek int, IsWeekend boolean, Month int, DayOfMonth int, "
    "PartOfDay string, DwellMinutes double, AreaName string, StreetId bigint, "
    "InViolation boolean, SignPlateID bigint, SideName string, SideOfStreet bigint, "
    "SideOfStreetCode string"
)

# What cleaning adds to the sample.
CLEAN = T.StructType(
    SAMPLE.fields
    + _schema(
        "_duration_min double, _occupied int, _event_time timestamp, _hour int, _dow int, "
        "_is_weekend int, _duration_outlier int, _duration_min_w double, "
        "_duration_robust_z double, street_marker_lumped string, device_id_lumped string, "
        "_duration_min_imp double, _occupied_imp int, target_occupied int, "
        "rolling_occ_N10 double, arrivals_N10 int"
    ).fields
)

ML_READY = _schema(
    "device_id string, street_marker string, sign_plate_id string, target_occupied int, "
    "hour int, dow int, is_weekend int, duration_min double"
)

# Times stay text here: the operators parse them.
STREAM_EVENT = _schema(
    "device_id string, street_marker string, event_time string, occupied int"
)

EVENTS_CSV = _schema(
    "DeviceId string, StreetMarker string, _event_time string, _occupied string"
)

IMPORTANCES = _schema("feature string, importance double")

# The model's feature lists and the columns that give the label away.
NUMERIC_FEATURES = [
    "Hour", "DayOfWeek", "IsWeekend", "Month", "DayOfMonth", "DwellMinutes", "InViolation",
    "_duration_min", "_hour", "_dow", "_is_weekend", "_duration_min_w",
    "_duration_robust_z", "rolling_occ_past10", "arrivals_N10",
]
CATEGORY_FEATURES = [
    "PartOfDay", "AreaName", "SideName", "SideOfStreetCode",
    "street_marker_lumped", "device_id_lumped",
]
WEIGHTED_FEATURES = [
    "hour", "dow", "is_weekend", "duration_min", "log_duration_min", "is_peak",
    "hour_x_weekend", "dow_x_weekend",
]
WEIGHTED_CATEGORIES = ["street_marker", "hour_bucket"]
LEAKY = ["Status", "_occupied", "_occupied_imp"]

PREDICTIONS = _schema(
    "label double, prediction double, prob_occupied double, "
    + ", ".join(f"{c} double" for c in NUMERIC_FEATURES)
    + ", "
    + ", ".join(f"{c} string" for c in CATEGORY_FEATURES)
)
