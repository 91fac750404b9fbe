"""Sinks for window streams.

In update mode a window comes again whenever it changes. Each micro-batch is written to a folder of its own
and entered in the manifest, which gives it a version; a reader takes the latest version of every window in
the folders that the manifest lists. A batch that is repeated after a failure is known by its run and number,
a stream with a new checkpoint is a new run whose versions follow the old ones. FANOUT folders of one level
are merged into one of the next, in which each window has one row, so the number of folders grows with the
logarithm of the batches, and a row is rewritten as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbline.sources import folders
from kerbline.streaming import manifest
from kerbline.streaming.manifest import Manifest

KEYS = ["window_start", "window_end", "street_marker"]
VERSION = "version"
#: Folders of one level that are merged into one of the next.
FANOUT = 8


def _latest(versions: DataFrame) -> DataFrame:
    """The newest row of each window, with its version."""
    rest = [c for c in versions.columns if c not in (*KEYS, VERSION)]
    newest = F.max_by(F.struct(*rest, VERSION), VERSION).alias("_last")
    return versions.groupBy(*KEYS).agg(newest).select(*KEYS, "_last.*")


def _merge(spark: SparkSession, path: str, held: Manifest, level: int) -> Manifest:
    """All folders of a level as one of the next."""
    old = [e for e in held.entries if e["level"] == level]
    name = f"data/level-{level + 1}-{old[-1]['version']:012d}"
    versions = spark.read.parquet(*[f"{path}/{e['folder']}" for e in old])
    _latest(versions).hint("rebalance").write.mode("overwrite").parquet(f"{path}/{name}")

    def change(made: Manifest) -> list[str]:
        # A merged folder is newer than all of its own level and older than what is left below.
        rest = [e for e in made.entries if e["level"] != level]
        made.entries = [
            *[e for e in rest if e["level"] > level],
            {"folder": name, "level": level + 1, "version": old[-1]["version"]},
            *[e for e in rest if e["level"] < level],
        ]
        return [e["folder"] for e in old]

    return manifest.commit(spark, path, held, change)


def write_windows(batch: DataFrame, number: int, path: str, run: str, fanout: int = FANOUT) -> None:
    """Add one micro-batch of changed windows to the table under `path`; a batch it has is left out."""
    spark = batch.sparkSession
    held = manifest.read(spark, path)
    if held.has(run, number):
        return
    version = held.number + 1
    name = f"data/run-{run}-{number:012d}"
    # few files per batch, however many partitions hold the state
    rows = batch.withColumn(VERSION, F.lit(version).cast("long")).hint("rebalance")
    rows.write.mode("overwrite").parquet(f"{path}/{name}")

    def change(made: Manifest) -> list[str]:
        made.entries.append({"folder": name, "level": 0, "version": version})
        made.done[run] = number
        return []

    held = manifest.commit(spark, path, held, change)
    level = 0
    while sum(e["level"] == level for e in held.entries) >= fanout:
        held = _merge(spark, path, held, level)
        level += 1


def start_window_sink(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    once: bool = False,
    every: str = "10 seconds",
    fanout: int = FANOUT,
) -> StreamingQuery:
    """Start writing window versions under `path`. `once` stops when the files at hand are read."""

    def write_batch(batch: DataFrame, number: int) -> None:
        write_windows(batch, number, path, manifest.run_of(batch.sparkSession, checkpoint), fanout)

    writer = (
        windows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def start_append_sink(
    windows: DataFrame, path: str, checkpoint: str, once: bool = False, every: str = "10 seconds"
) -> StreamingQuery:
    """Write each row once, when the watermark has passed it."""
    writer = (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def start_console(
    windows: DataFrame, checkpoint: str, mode: str = "update", once: bool = False
) -> StreamingQuery:
    """Print changed windows, for a look at a running stream."""
    writer = (
        windows.writeStream.outputMode(mode)
        .format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """Current state of every window that an update sink has written."""
    held = manifest.read(spark, path)
    if not held.entries:
        raise FileNotFoundError(f"no windows under {path}")
    return _latest(spark.read.parquet(*held.folders(path))).drop(VERSION)


def written_folders(spark: SparkSession, path: str) -> int:
    """Data folders under `path`, those waiting for their removal included."""
    return len(folders.names(spark, f"{path}/data"))
