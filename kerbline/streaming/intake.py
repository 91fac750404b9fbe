"""Intake of event files: every line ends as an event or as a reject with its reason.

Lines are read as text and parsed under the schema, so none is skipped, and rejects keep their line. A line is
`corrupt` if it is no JSON of the schema, `no time` or `no street` if it lacks them, and `late` if the last
window it belongs to had closed: its end lies more than the delay before the latest time of the batches
before. So input lines = events + rejects, and a window stream over the events, with the same delay, has a
window left for each.

Each micro-batch is one folder with both parts, entered in a manifest that also carries the latest time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from kerbline import schemas
from kerbline.functions.times import micros, parse_event_time
from kerbline.sources import folders
from kerbline.streaming import manifest
from kerbline.streaming.manifest import Manifest
from kerbline.streaming.windows import MINUTE

CORRUPT = "_corrupt"
LATEST = "latest_us"
ROW = (
    "value string, device_id string, street_marker string, event_time string, occupied int, "
    "event_time_ts timestamp, reason string, accepted boolean"
)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines (`value`) with the event's fields, its time, and `reason` (null if it is usable)."""
    schema = StructType([*schemas.STREAM_EVENT.fields, StructField(CORRUPT, StringType())])
    read = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    fields = lines.select("value", read.alias("_event")).select("value", "_event.*", F.col("_event").isNull().alias("_none"))
    timed = fields.withColumn("event_time_ts", parse_event_time(F.col("event_time")))
    reason = (
        F.when(F.col("_none") | F.col(CORRUPT).isNotNull(), "corrupt")
        .when(F.col("event_time_ts").isNull(), "no time")
        .when(F.col("street_marker").isNull(), "no street")
    )
    return timed.select("value", *schemas.STREAM_EVENT.fieldNames(), "event_time_ts", reason.alias("reason"))


def with_late(parsed: DataFrame, latest: int | None, delay: int, size: int, slide: int) -> DataFrame:
    """Mark usable rows whose windows had all closed; times are in microseconds."""
    if latest is None:
        return parsed
    last_end = F.floor(micros(F.col("event_time_ts")) / slide) * slide + size
    late = F.when(last_end <= latest - delay, "late")
    return parsed.withColumn("reason", F.coalesce("reason", late))


def write_lines(
    batch: DataFrame, number: int, out: str, run: str, delay: int, size: int, slide: int
) -> None:
    """Parse one micro-batch of lines and add it under `out`; a batch that is there is left out."""
    spark = batch.sparkSession
    held = manifest.read(spark, out)
    if held.has(run, number):
        return
    folder = f"{out}/lines/batch={run}-{number:012d}"
    if not folders.complete(spark, folder):
        parsed = with_late(parse_lines(batch), held.notes.get(LATEST), delay, size, slide)
        marked = parsed.withColumn("accepted", F.col("reason").isNull())
        marked.hint("rebalance").write.mode("overwrite").partitionBy("accepted").parquet(folder)
    rows = spark.read.schema(ROW).parquet(folder).filter("accepted")
    newest = rows.agg(F.max(micros(F.col("event_time_ts")))).first()[0]

    def change(made: Manifest) -> list[str]:
        times = [t for t in (newest, made.notes.get(LATEST)) if t is not None]
        made.notes[LATEST] = max(times, default=None)
        made.done[run] = number
        return []

    manifest.commit(spark, out, held, change)


def start_intake(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    delay_minutes: int = 10,
    size_minutes: int = 5,
    slide_minutes: int = 1,
    max_files: int = 1000,
    once: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Start taking in the files of a folder. `once` stops when the files at hand are read."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(source)
    spans = [m * MINUTE for m in (delay_minutes, size_minutes, slide_minutes)]

    def take(batch: DataFrame, number: int) -> None:
        write_lines(batch, number, out, manifest.run_of(batch.sparkSession, checkpoint), *spans)

    trigger = {"availableNow": True} if once else {"processingTime": every}
    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
    return writer.trigger(**trigger).start()


def _lines(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"{ROW}, batch string").parquet(f"{out}/lines")


def events(spark: SparkSession, out: str) -> DataFrame:
    """Accepted events so far, with `event_time_ts`."""
    return _lines(spark, out).filter("accepted").select(*schemas.STREAM_EVENT.fieldNames(), "event_time_ts")


def rejects(spark: SparkSession, out: str) -> DataFrame:
    """Rejected lines so far with their reason."""
    return _lines(spark, out).filter("NOT accepted").select("value", "event_time_ts", "reason")


def event_stream(spark: SparkSession, out: str, max_files: int = 1000) -> DataFrame:
    """Stream of the accepted events, for windows."""
    rows = (
        spark.readStream.schema(ROW)
        .option("maxFilesPerTrigger", max_files)
        .parquet(f"{out}/lines/*/accepted=true")
    )
    return rows.select(*schemas.STREAM_EVENT.fieldNames(), "event_time_ts")
