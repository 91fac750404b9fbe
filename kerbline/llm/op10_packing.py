"""Packing token sequences into rows of fixed length by best fit decreasing.

A document longer than a row is split: its full parts fill rows of their own, its rest is packed. Rests are
placed by decreasing length, each into the row with the smallest room that is enough. That room is found
in a segment tree over all sizes of room: a node tells whether any row below it has such room, so a
search goes up and down the tree once, whatever the number of rows.

A task packs its documents in groups of a fixed number of tokens, so nothing is shuffled and memory is
bounded; only the last rows of a group may stay partly empty. No token is dropped. Every row carries its
ids padded to the full length, the cumulative lengths of its segments, the places where positions start
again at 0, and each segment's document and offset there, which makes the split reversible.

A null or empty sequence makes no segment. Repeated documents are packed each. Ties in length keep the
order of input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm.op11_tiktoken import ids_of

NAME = "op10_packing"
LENGTH = 8192
#: Tokens packed together.
GROUP = 512 * LENGTH
KIND = "<u2"
#: The id that the vocabulary leaves free ends a text; it also fills rows.
END = PAD = 50_256


class Rooms:
    """Rows by the room they have left: a segment tree over sizes 0 ... largest."""

    def __init__(self, largest: int):
        self.width = 1 << largest.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        at = room + self.width
        while at:
            self.count[at] += 1
            at >>= 1

    def best(self, size: int) -> tuple[int, int] | None:
        """Take out the row with the smallest room of at least `size`: (room, row)."""
        at = size + self.width
        if not self.count[at]:
            # Up until a right neighbour has rows, then down to its smallest.
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at *= 2
                if not self.count[at]:
                    at += 1
        room = at - self.width
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, self.rows[room].pop()


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows of indices into `sizes` (each 1 ... length), by best fit decreasing."""
    rooms, rows = Rooms(length), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = rooms.best(size)
        if found is None:
            found = length, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(i)
        if room > size:
            rooms.add(room - size, row)
    return rows


def _rows(pieces: list, length: int, kind: str, pad: int, id_kind: pa.DataType) -> pa.RecordBatch:
    """Packed rows of pieces (document, offset, ids)."""
    sizes = np.array([len(p[2]) for p in pieces], np.int64)
    rows = best_fit(sizes, length)
    ids, cumulative, resets, docs, offsets = [], [], [], [], []
    for row in rows:
        own = [pieces[i] for i in row]
        matrix = np.full(length, pad, kind)
        ends = np.cumsum(sizes[row])
        matrix[: ends[-1]] = np.concatenate([p[2] for p in own])
        ids.append(matrix.tobytes())
        cumulative.append(np.concatenate([[0], ends]))
        resets.append(ends - sizes[row])
        docs.append([p[0] for p in own])
        offsets.append([p[1] for p in own])
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.binary()),
            pa.array([c[-1] for c in cumulative], pa.int32()),
            pa.array(cumulative, ints),
            pa.array(resets, ints),
            pa.array(docs, pa.list_(id_kind)),
            pa.array(offsets, longs),
        ],
        ["input_ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "doc_offsets"],
    )


def pack(
    docs: DataFrame,
    source: Column,
    length: int = LENGTH,
    kind: str = KIND,
    pad: int = PAD,
    group: int = GROUP,
    tokenise: Callable[[str | bytes | None], np.ndarray] | None = None,
) -> DataFrame:
    """Packed rows of all documents: pack_id, input_ids (`length` ids of `kind`), n_tokens, cu_seqlens,
    position_resets, doc_ids, doc_offsets.

    `docs` has doc_id. `source` is a binary column of packed ids, or what `tokenise` makes ids of one
    value at a time.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, held = [], 0
        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            for doc, data in zip(batch["doc_id"].to_pylist(), batch["source"], strict=True):
                tokens = tokenise(data.as_py()) if tokenise else np.frombuffer(data.as_py() or b"", kind)
                for at in range(0, len(tokens), length):
                    pieces.append((doc, at, tokens[at : at + length]))
                held += len(tokens)
                if held >= group:
                    yield _rows(pieces, length, kind, pad, id_kind)
                    pieces, held = [], 0
        if pieces:
            yield _rows(pieces, length, kind, pad, id_kind)

    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    packed = docs.select("doc_id", source.alias("source")).mapInArrow(
        over,
        "input_ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
        f"doc_ids array<{doc_kind}>, doc_offsets array<long>",
    )
    return packed.select(F.monotonically_increasing_id().alias("pack_id"), "*")


def unpack(packed: DataFrame, kind: str = KIND) -> DataFrame:
    """The segments of packed rows: doc_id, doc_offset and their ids as binary."""
    width = np.dtype(kind).itemsize
    parts = F.arrays_zip("doc_ids", "doc_offsets", "position_resets")
    return packed.select(
        "input_ids", "cu_seqlens", F.posexplode(parts).alias("k", "part")
    ).select(
        F.col("part.doc_ids").alias("doc_id"),
        F.col("part.doc_offsets").alias("doc_offset"),
        F.expr(
            f"substring(input_ids, part.position_resets * {width} + 1,"
            f" (cu_seqlens[k + 1] - cu_seqlens[k]) * {width})"
        ).alias("ids"),
    )


def positions(packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add position_ids: from 0 in every segment, and 0 in the padding."""
    spread = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size("cu_seqlens") - 1),
            lambda k: F.sequence(F.lit(0), F.get("cu_seqlens", k) - F.get("cu_seqlens", k - 1) - 1),
        )
    )
    padding = F.array_repeat(F.lit(0), F.lit(length) - F.col("n_tokens"))
    return packed.withColumn("position_ids", F.concat(spread, padding))


def write(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: a row is one row of the id matrix with its segments."""
    packed.write.option("compression", "zstd").parquet(path)


def bpe_ids(text: str | None) -> np.ndarray:
    """Byte-level BPE ids of a text, 16 bits wide, then the end id."""
    return np.array([*ids_of(text or ""), END], KIND)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, as BPE ids with an end id each, in packed rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return pack(docs, F.col("text"), tokenise=bpe_ids)
