"""Scans. Each has a schema, so no reader passes over the data to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline import schemas
from kerbline.operators.cleaning import parse_event_times

# Encodings of the event export that Spark's CSV reader takes. Windows Latin text is
# read as ISO Latin 1, then the 32 codes on which the two differ are mapped.
ENCODINGS = {"utf-8-sig": "UTF-8", "cp1252": "ISO-8859-1"}
WINDOWS = {chr(c): bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)}


def read_clean_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.CLEAN) -> DataFrame:
    """CSV with a header, typed by the schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def breaks_in_fields(spark: SparkSession, path: str) -> bool:
    """Whether some field of a CSV may hold a line break: a line with an odd number of quotes opens one.

    Doubled quotes inside a field come in pairs. The lines are looked at by many tasks, until one is found.
    """
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.filter(quotes % 2 == 1).isEmpty()


def read_loose_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """CSV as text only, with line breaks and doubled quotes inside fields.

    A file that has line breaks in fields cannot be split, so it is read by one task; others are cut into
    parts for many tasks. A look at the lines decides, unless `multi_line` says what the files have.
    """
    if multi_line is None:
        multi_line = breaks_in_fields(spark, path)
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Sensor export: the known columns (or some of them) by header name, whatever else it has.

    The header gives the order of the columns in the file; only the wanted ones are parsed.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schemas.RAW.fields}
    in_file = T.StructType(
        [known.get(name.strip(), T.StructField(name, T.StringType())) for name in header]
    )
    wanted = [c for c in (columns or schemas.RAW.fieldNames()) if c in in_file.fieldNames()]
    return spark.read.schema(in_file).option("header", True).csv(path).select(*wanted)


def read_events_csv(spark: SparkSession, path: str, encoding: str = "utf-8-sig") -> DataFrame:
    """Event export with records ended by any of CR, LF, CRLF and empty columns at the end."""
    rows = (
        spark.read.schema(schemas.EVENTS_CSV)
        .option("header", True)
        .option("enforceSchema", True)
        .option("encoding", ENCODINGS.get(encoding, encoding))
        .csv(path)
    )
    if encoding != "cp1252":
        return rows
    mapped = [F.translate(c, "".join(WINDOWS), "".join(WINDOWS.values())).alias(c) for c in rows.columns]
    return rows.select(*mapped)


def read_events_json(spark: SparkSession, path: str) -> DataFrame:
    """Stream events from JSON lines, with `event_time_ts`; unusable rows are skipped."""
    return parse_event_times(spark.read.schema(schemas.STREAM_EVENT).json(path))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return _csv_or_parquet(spark, path, schemas.PREDICTIONS)


def read_importances(spark: SparkSession, path: str) -> DataFrame:
    return _csv_or_parquet(spark, path, schemas.IMPORTANCES)


def _csv_or_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schema.fields}
    in_file = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in header])
    return spark.read.schema(in_file).option("header", True).csv(path)


def read_bronze(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Bronze events; a range of dates (`yyyy-mm-dd`, both included) reads only their folders."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(f"event_date >= date'{first}'")
    if last is not None:
        rows = rows.filter(f"event_date <= date'{last}'")
    return rows
