"""A list of the folders that make up a growing table, changed in one step.

Every change writes the whole list under a new number. Spark marks a finished write last, so a list counts
once it is marked: readers take the highest such number, and a change that fails leaves the one before.
There is one writer at a time, the stream's driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from kerbline.sources import folders

#: Lists that stay behind the newest, for readers that have just looked.
KEPT = 3


@dataclass
class Manifest:
    """Folders in order of age, each with its level and the number of its newest version.

    `done` has the last batch of each run (a run is a checkpoint's life); `stale` the folders that were
    replaced by the change before; `notes` what a writer carries from batch to batch.
    """

    number: int = 0
    entries: list[dict] = field(default_factory=list)
    done: dict[str, int] = field(default_factory=dict)
    stale: list[str] = field(default_factory=list)
    notes: dict = field(default_factory=dict)

    def folders(self, path: str) -> list[str]:
        return [f"{path}/{entry['folder']}" for entry in self.entries]

    def has(self, run: str, batch: int) -> bool:
        return self.done.get(run, -1) >= batch


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted((int(n) for n in folders.names(spark, f"{path}/manifest") if n.isdigit()), reverse=True)


def read(spark: SparkSession, path: str) -> Manifest:
    for number in _numbers(spark, path):
        home = f"{path}/manifest/{number:012d}"
        if folders.complete(spark, home):
            return Manifest(**json.loads(spark.read.text(home).first()[0]))
    return Manifest()


def commit(spark: SparkSession, path: str, held: Manifest, change: Callable[[Manifest], list[str]]) -> Manifest:
    """Apply a change, which returns the folders it replaced, and publish the list.

    Folders that an earlier change replaced are removed now, so readers have had the time of one change.
    """
    made = Manifest(**json.loads(json.dumps(asdict(held))))
    made.number += 1
    made.stale = change(made)
    row = spark.createDataFrame([(json.dumps(asdict(made)),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/manifest/{made.number:012d}")
    for folder in held.stale:
        folders.remove(spark, f"{path}/{folder}")
    for number in _numbers(spark, path)[KEPT:]:
        folders.remove(spark, f"{path}/manifest/{number:012d}")
    return made


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
