"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A text's words are runs of anything but white space, A-Z in lower case; its shingles are its runs of
three words joined by one space, repeats included (fewer words: all of them; none: no shingle). A bit
of the 64-bit fingerprint is 1 if over half of the shingles' XXH64 values (seed 42) have it. Texts
link if their fingerprints differ in at most 2 bits; linked texts form groups.

Search: every bit position i gets a vector m(i) of 3 bits, not zero. For each of the 7 vectors v that
are not zero, a mask takes the positions where m(i) and v have an odd number of common bits. The
vectors of 2 differing positions leave some v orthogonal to both, so the two fingerprints agree on
that mask: every linked pair meets in one of 7 tables. Buckets of more than 64 fingerprints are cut
again by 7 masks over the positions their mask leaves free, in the same way. At most 12 positions are
then free, so no bucket can hold more than 4,096 fingerprints, however large a group of near copies
is. A bucket yields a spanning forest of its links, not all pairs.

Copies share a fingerprint and are one node. Null texts and texts without words have fingerprint zero.
A document with a null id is linked too; groups are named by their smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm.components import components
from kerbline.plans.durable import attach, durable

NAME = "op3_simhash"
SHINGLE = 3
RADIUS = 2
BITS = 64
#: Larger buckets are cut again.
BUCKET = 64
#: Shingles whose bits are counted at once.
BLOCK = 100_000

FP = "_fingerprint"
ROW = "_row"


def fingerprint(text: str | None) -> int:
    """SimHash of a text, unsigned."""
    words = (text or "").encode().lower().split()  # white space: 0x20, 0x09-0x0D
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    joined = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    n = len(words) - size + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), joined), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def fingerprints(text: Column) -> Column:
    """Fingerprints of a text column as signed longs."""

    def over(column: pa.Array) -> pa.Array:
        # text by text, so that a batch is not held twice
        return pa.array((_signed(fingerprint(t.as_py())) for t in column), pa.int64())

    return F.arrow_udf(over, "long")(text)


def covering(free: list[int]) -> list[int]:
    """Masks over the given bit positions such that any RADIUS of them avoid some mask.

    The vectors are dealt evenly, so every mask leaves about 3/7 of the positions free.
    """
    vectors = 2 ** (RADIUS + 1) - 1
    given = {position: 1 + k % vectors for k, position in enumerate(free)}
    return [
        sum(1 << i for i, m in given.items() if (m & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _deal(positions: list[int]) -> list[int]:
    """Positions in a fixed mixed order, so that a mask is spread over the fingerprint."""
    return sorted(positions, key=lambda i: (i * 37 + 11) % 67)


FIRST = covering(_deal(list(range(BITS))))
SECOND = [covering(_deal([i for i in range(BITS) if not mask >> i & 1])) for mask in FIRST]


def _joint(bucket: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest (larger, smaller) of the links among a bucket's distinct fingerprints."""
    n = len(bucket)
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    if n <= BUCKET:
        apart = np.bitwise_count(bucket[:, None] ^ bucket[None, :])
        pairs = np.argwhere(np.triu(apart <= RADIUS, 1)).tolist()
    else:
        differing = int(np.bitwise_or.reduce(bucket ^ bucket[0]))
        free = [1 << i for i in range(BITS) if differing >> i & 1]
        order = np.argsort(bucket)
        ranked = bucket[order]
        pairs = []
        for count in range(1, RADIUS + 1):
            for flips in combinations(free, count):
                other = bucket ^ np.uint64(sum(flips))
                at = np.minimum(np.searchsorted(ranked, other), n - 1)
                met = np.flatnonzero((ranked[at] == other) & (other > bucket))
                pairs.extend(zip(met.tolist(), order[at[met]].tolist(), strict=True))
    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    signed = bucket.view(np.int64).tolist()
    # Buckets come in ascending order of the signed value, so a root is its tree's smallest.
    return [(signed[i], signed[top(i)]) for i in range(n) if top(i) != i]


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        edges = []
        for bucket in batch["bucket"]:
            edges += _joint(np.sort(bucket.values.to_numpy()).view(np.uint64))
        u, v = zip(*edges, strict=True) if edges else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"]
        )


def links(nodes: DataFrame) -> DataFrame:
    """Edges u > v that join all distinct fingerprints linked by chains; `nodes` has them once."""
    masks = F.array(*[F.lit(_signed(m)) for m in FIRST])
    rows = nodes.select(FP, F.posexplode(masks).alias("table", "mask")).select(
        FP, "table", F.col(FP).bitwiseAND(F.col("mask")).alias("key")
    )
    crowded = (
        rows.groupBy("table", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > BUCKET)
        .select("table", "key", F.lit(True).alias("crowded"))
    )
    finer = F.element_at(
        F.array(*[F.array(*[F.lit(_signed(m)) for m in masks]) for masks in SECOND]),
        F.col("table") + 1,
    )
    split = (
        attach(rows, crowded, ["table", "key"])
        .select(
            FP, "table", "key",
            F.posexplode(F.when(F.col("crowded"), finer).otherwise(F.array(F.lit(0).cast("long"))))
            .alias("part", "mask"),
        )
        .withColumn("inner", F.col(FP).bitwiseAND(F.col("mask")))
    )
    return (
        split.groupBy("table", "key", "part", "inner")
        .agg(F.collect_list(FP).alias("bucket"))  # at most 4,096 by the masks
        .filter(F.size("bucket") > 1)
        .select("bucket")
        .mapInArrow(_link, "u long, v long")
    )


def grouped(prints: DataFrame) -> DataFrame:
    """Add `_root`, the same for all rows of a group. `prints` should be a stored table with FP."""
    nodes = durable(prints.select(FP).distinct())
    roots = components(links(nodes))
    return attach(prints, roots.select(F.col("u").alias(FP), F.col("v").alias("_root")), [FP]).withColumn(
        "_root", F.coalesce("_root", FP)
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = durable(docs.select("doc_id", fingerprints(F.col("text")).alias(FP)))
    rooted = durable(grouped(prints))
    named = rooted.groupBy("_root").agg(F.min("doc_id").alias("component_id"))
    return attach(rooted, named, ["_root"]).select(
        "doc_id",
        F.lower(F.lpad(F.hex(FP), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each group, that with the smallest id (null last); all columns stay, whatever their names."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    held = durable(
        docs.select(whole, "doc_id", fingerprints(F.col("text")).alias(FP), F.monotonically_increasing_id().alias(ROW))
    )
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    kept = (
        grouped(held.select("doc_id", ROW, FP))
        .groupBy("_root")
        .agg(F.min(first).alias("first"))
        .select(F.col(f"first.{ROW}").alias(ROW))
    )
    return attach(held, kept, [ROW], "left_semi").select("row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
