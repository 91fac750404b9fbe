"""Token counts of flat token files by a scan for separators.

A token file is nothing but token ids as little-endian integers of one width; every document is followed
by an end-of-document id, and there is no index. Files are cut into blocks without looking inside, so one
file is read by many tasks. A task compares its block with the separator in one vectorised pass and
keeps the places it finds. Blocks are stitched by a prefix scan over their few numbers: how many
documents ended before, and where the last separator lies. A document may span any number of blocks.

Files come from any store that pyarrow opens (local and shared folders, HDFS, object stores). The writer
uses Spark's text sink, whose line separator is the end-of-document id, so a lost task leaves no half
file. An empty or null text is a document of 0 tokens. Tokens after the last separator are a document
that is not `ended`. An empty file has none. Bytes beyond a whole number of ids are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.op8_bpe import VOCABULARY, encoded
from kerbline.plans.durable import attach, durable, shared_folder

NAME = "op5_token_counts"
KIND = "<u2"
#: <|endoftext|> of the vocabulary
END = 50256
#: Bytes of a file that one task looks at together; a multiple of every id's width.
BLOCK = 16 * 2**20


def write_tokens(docs: DataFrame, ids: Column, path: str, end: int = END, kind: str = KIND) -> None:
    """Write packed ids (binary) as flat token files, each document followed by `end`.

    The ids themselves must not hold `end`.
    """
    separator = np.array([end], kind).tobytes().decode("latin-1")
    docs.select(ids.cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option(
        "lineSep", separator
    ).text(path)


def _open(path: str):
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        path = "file:///" + rest.lstrip("/")
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def separators(spark: SparkSession, path: str, end: int = END, kind: str = KIND, block: int = BLOCK) -> DataFrame:
    """Per block: file, begin, upto (token places in the file) and the places of separators."""
    width = np.dtype(kind).itemsize

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, begin, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _open(file) as held:
                    held.seek(begin)
                    ids = np.frombuffer(held.read(stop - begin), kind)
                ends = np.flatnonzero(ids == end) + begin // width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file]),
                        pa.array([begin // width]),
                        pa.array([stop // width]),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    ["file", "begin", "upto", "ends"],
                )

    # Only names and lengths are read here; the files' content stays where it is.
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "length")
    whole = F.when(F.col("length") % width == 0, F.col("length")).otherwise(
        F.raise_error(F.concat(F.lit("no whole number of ids in "), F.col("path")))
    )
    blocks = files.select(
        F.col("path").alias("file"),
        whole.alias("length"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block))).alias("from"),
    ).select("file", "from", F.least("length", F.col("from") + block).alias("upto"))
    cores = spark.sparkContext.defaultParallelism
    return blocks.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(
        look, "file string, begin long, upto long, ends array<long>"
    )


def token_counts(spark: SparkSession, path: str, end: int = END, kind: str = KIND, block: int = BLOCK) -> DataFrame:
    """Per document: file, doc_index (from 0 in its file), start (token place), n_tokens, ended."""
    seen = durable(separators(spark, path, end, kind, block))
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    numbers = seen.select("file", "begin", F.size("ends").alias("n"), F.expr("get(ends, size(ends) - 1)").alias("last"))
    stitched = numbers.select(
        "file",
        "begin",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)).alias("end_before"),
    )
    starts = F.transform("ends", lambda e, i: F.when(i == 0, F.col("end_before")).otherwise(F.get("ends", i - 1)) + 1)
    ended = (
        attach(seen, stitched, ["file", "begin"])
        .select("file", "docs_before", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))))
        .select(
            "file",
            (F.col("docs_before") + F.col("pos")).alias("doc_index"),
            F.col("col.start").alias("start"),
            (F.col("col.end") - F.col("col.start")).alias("n_tokens"),
            F.lit(True).alias("ended"),
        )
    )
    upto = seen.groupBy("file").agg(
        F.max("upto").alias("upto"),
        F.sum(F.size("ends")).alias("doc_index"),
        (F.coalesce(F.max(F.array_max("ends")), F.lit(-1)) + 1).alias("start"),
    )
    open_ended = upto.filter("upto > start").select(
        "file", "doc_index", "start", (F.col("upto") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return ended.unionByName(open_ended)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents, written to flat files of 16-bit ids and scanned."""
    path = f"{shared_folder(spark)}/tokens-{uuid4().hex}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    write_tokens(docs, encoded(F.col("text"), VOCABULARY, KIND, added=False), path)
    counts = token_counts(spark, path)
    return counts.withColumn("file", F.regexp_extract("file", r"part-(\d+)", 1).cast("long"))
