"""Hard-negative mining by a vertical scan of columnar dimensions (BOND).

Each task turns its rows into blocks with one array per dimension, sorted by label, and notes the least and
greatest value of each dimension. An anchor reads a block's dimensions in descending order of its own
magnitudes. After every few dimensions the unread ones can add at most what the block's extremes allow, so
each row has a lower and an upper bound; rows that can no longer enter the result leave the candidate
bitmap, and the rest end with exact scores. There are two scans: for the anchors' best rows of the same
label (positives), then for the best rows of other labels in the window under each positive's score. What
a task has found so far for an anchor raises the threshold for its next blocks.

Anchors are dealt to chunks of at most CHUNK bytes by their place in a distributed order. A chunk and its
positives go to every task; the rows do not move, only a few finds for each anchor and task are shuffled.
So a hot label, or copies of one vector, put no more rows into a task than others.

The score of two rows is the inner product of their integer codes, exact; a shorter vector is filled with
zeros. Products that might not fit a long are an error. Rows without vec_id, label or codes, or with a null
code, take no part. Repeated rows count each, but rows with the anchor's own vec_id are not its positives.
Ties go to the smaller vec_id. An anchor without positives, and a positive without rows in its window, gives
no row. Columns other than vec_id, label and codes are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.plans.durable import durable, shared_folder
from kerbline.plans.slices import positions

NAME = "op13_hard_negatives"
POSITIVES = 5
NEGATIVES = 5
#: A negative has at least so many per cent of the positive's score.
LEAST_PERCENT = 80
#: Codes are floor(SCALE * component).
SCALE = 256
#: Rows of a block, and dimensions read between two looks at the bounds.
ROWS = 16_384
STEP = 8
#: Bytes of the anchors that go to every task at once.
CHUNK = 8_000_000

NONE = np.iinfo(np.int64).min
FOUND = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


@dataclass
class Anchors:
    """Anchors of one chunk, row i of `codes` with id `ids[i]`, and how rows are read against them."""

    ids: np.ndarray
    labels: np.ndarray
    codes: np.ndarray
    rows: int = ROWS
    step: int = STEP


def _matrix(codes: pa.Array) -> np.ndarray:
    """Lists of codes as rows of a matrix, short ones filled with zeros."""
    sizes = codes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = codes.flatten().to_numpy(zero_copy_only=False)
    wide = int(sizes.max(initial=0))
    if (sizes == wide).all():
        return flat.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


def _largest(codes: np.ndarray) -> int:
    return max(abs(int(codes.max(initial=0))), abs(int(codes.min(initial=0))))


class Block:
    """Rows in columns, sorted by label, with the extremes of each dimension."""

    def __init__(self, rows: pa.Table, anchors: Anchors):
        rows = rows.combine_chunks()
        labels = rows["label"].to_numpy()
        ranked = np.argsort(labels, kind="stable")
        self.ids, self.labels = rows["vec_id"].to_numpy()[ranked], labels[ranked]
        codes = _matrix(rows["codes"].chunk(0) if rows["codes"].num_chunks else rows["codes"].combine_chunks())
        most = _largest(codes) * _largest(anchors.codes) * max(codes.shape[1], 1)
        if most >= 2**62:
            raise ArithmeticError(f"{NAME}: scores of these codes may not fit a long")
        kind = np.int32 if most < 2**30 else np.int64
        self.columns = np.ascontiguousarray(codes[ranked].T.astype(kind))
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.step = anchors.step

    def range(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))

    def scan(
        self, vector: np.ndarray, begin: int, end: int, outside: bool, low: int, high: int, sure: int, most: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of rows in (or outside) begin:end with a score from `low` to `high`.

        Rows that `most` others with scores up to `sure` surpass may be left out.
        """
        vector = vector[: len(self.columns)]
        order = np.argsort(-np.abs(vector), kind="stable")
        order = order[vector[order] != 0]
        weights = vector[order].astype(self.columns.dtype)
        ends = np.stack([weights * self.low[order], weights * self.high[order]]).astype(np.int64)
        rest_low = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        n = len(self.ids) if outside else end - begin
        first = 0 if outside else begin
        at = None  # all n rows
        scores = np.zeros(n, self.columns.dtype)
        for step in range(0, max(len(order), 1), self.step):
            done = min(step + self.step, len(order))
            for j in range(step, done):
                column = self.columns[order[j]]
                scores += weights[j] * (column[first : first + n] if at is None else column[at])
            lower, upper = scores + rest_low[done], scores + rest_high[done]
            candidates = (lower <= high) & (upper >= low)
            if at is None and outside:
                candidates[begin:end] = False
            if len(scores) > most:
                certain = lower[candidates & (upper <= sure)]
                if len(certain) >= most:
                    low = max(low, int(np.partition(certain, -most)[-most]))
                    candidates &= upper >= low
            kept = np.flatnonzero(candidates)
            at = kept + first if at is None else at[kept]
            scores = scores[kept]
            if not len(at):
                break
        return at, scores.astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[Block]:
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, anchors.rows - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == anchors.rows:
                yield Block(pa.Table.from_batches(held), anchors)
                held, n = [], 0
    if n:
        yield Block(pa.Table.from_batches(held), anchors)


def _better(scores: np.ndarray, ids: np.ndarray, more: np.ndarray, more_ids: np.ndarray) -> None:
    """Keep in `scores` and `ids` the best of these and more, highest first, ties by id."""
    scores_all, ids_all = np.concatenate([scores, more]), np.concatenate([ids, more_ids])
    best = np.lexsort((ids_all, -scores_all))[: len(scores)]
    scores[:], ids[:] = scores_all[best], ids_all[best]


def _best_same(anchors, most: int) -> Callable:
    """Best rows of the anchors' label in a task: anchor's place in the chunk, vec_id, score."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Anchors = anchors.value
        scores = np.full((len(held.ids), most), NONE + 1)
        ids = np.full(scores.shape, np.iinfo(np.int64).max)
        for block in _blocks(batches, held):
            for i, label in enumerate(held.labels.tolist()):
                begin, end = block.range(label)
                if begin == end:
                    continue
                # One more than asked for, as the anchor itself is among them.
                low = int(scores[i, -1])
                own = block.ids[begin:end] == held.ids[i]
                at, found = block.scan(
                    held.codes[i], begin, end, False, low, 2**62, 2**62, most + int(own.sum())
                )
                others = block.ids[at] != held.ids[i]
                if others.any():
                    _better(scores[i], ids[i], found[others], block.ids[at[others]])
        of, k = np.nonzero(scores > NONE + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(of), pa.array(ids[of, k]), pa.array(scores[of, k])], ["of", "vec_id", "score"]
        )

    return over


def _best_other(anchors, positives, most: int, percent: int) -> Callable:
    """Best rows of other labels in each positive's window in a task."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Anchors = anchors.value
        of, positive_ids, tops = positives.value
        floors = -((-percent * tops) // 100)
        scores = np.full((len(of), most), NONE + 1)
        ids = np.full(scores.shape, np.iinfo(np.int64).max)
        # Positives of an anchor lie together, with the highest score first; windows may be empty.
        cuts = np.searchsorted(of, np.arange(len(held.ids) + 1))
        for block in _blocks(batches, held):
            for i, label in enumerate(held.labels.tolist()):
                own = [k for k in range(cuts[i], cuts[i + 1]) if floors[k] <= tops[k]]
                if not own:
                    continue
                last = own[-1]
                low, high = max(int(floors[own].min()), int(scores[last, -1])), int(tops[own[0]])
                begin, end = block.range(label)
                at, found = block.scan(held.codes[i], begin, end, True, low, high, int(tops[last]), most)
                if not len(at):
                    continue
                for k in own:
                    inside = (found <= tops[k]) & (found >= floors[k])
                    if inside.any():
                        _better(scores[k], ids[k], found[inside], block.ids[at[inside]])
        k, j = np.nonzero(scores > NONE + 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(k), pa.array(held.ids[of[k]]), pa.array(positive_ids[k]), pa.array(ids[k, j]),
                pa.array(tops[k]), pa.array(scores[k, j]),
            ],
            ["of", "anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"],
        )

    return over


def mine(
    vectors: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    block_rows: int = ROWS,
    step: int = STEP,
) -> DataFrame:
    """Hard negatives of the rows for which `anchor` holds, from vectors (vec_id, label, codes).

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and
    each of its best rows of the same label, the best rows of other labels whose score is at most the
    positive's and at least `least_percent` per cent of it. Blocks have at most `block_rows` rows, whose
    bounds are looked at after every `step` dimensions.
    """
    spark = vectors.sparkSession
    rows = durable(
        vectors.select(
            F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("codes").cast("array<long>")
        ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND codes IS NOT NULL AND forall(codes, c -> c IS NOT NULL)")
    )
    chosen = durable(positions(rows.filter(anchor), ["vec_id"], "at"))
    total, wide = chosen.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("codes")), F.lit(0))).first()
    each = max(CHUNK // (8 * wide + 16), 1)
    home = f"{shared_folder(spark)}/negatives-{uuid4().hex}"
    for begin in range(0, total, each):
        part = chosen.filter(F.col("at").between(begin, begin + each - 1)).toArrow().sort_by("at").combine_chunks()
        anchors = spark.sparkContext.broadcast(
            Anchors(
                part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(part["codes"].chunk(0)), block_rows, step
            )
        )
        by = Window.partitionBy("of").orderBy(F.desc("score"), "vec_id")
        best = (
            rows.mapInArrow(_best_same(anchors, positives), "of long, vec_id long, score long")
            .withColumn("rank", F.row_number().over(by))
            .filter(F.col("rank") <= positives)
            .toArrow()  # at most `positives` rows for each anchor of the chunk
            .sort_by([("of", "ascending"), ("rank", "ascending")])
        )
        tops = spark.sparkContext.broadcast(tuple(best[c].to_numpy() for c in ("of", "vec_id", "score")))
        by = Window.partitionBy("of").orderBy(F.desc("negative_score"), "negative_id")
        (
            rows.mapInArrow(_best_other(anchors, tops, negatives, least_percent), f"of long, {FOUND}")
            .withColumn("rank", F.row_number().over(by))
            .filter(F.col("rank") <= negatives)
            .drop("of")
            .write.mode("append")
            .parquet(home)
        )
        anchors.unpersist()
        tops.unpersist()
    schema = f"{FOUND}, rank int"
    found = spark.read.schema(schema).parquet(home) if total else spark.createDataFrame([], schema)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def coded(embedding: Column, scale: int = SCALE) -> Column:
    """Integer codes floor(scale * component); null for a vector with a null or non-finite component."""
    whole = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.when(whole, F.transform(embedding, lambda x: F.floor(x.cast("double") * float(scale))))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the next label."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.expr("if(vec_id % 7 = 0, (cast(label AS long) + 1) % 10, label)").alias("label")
    return mine(rows.select("vec_id", label, coded(F.col("embedding")).alias("codes")), F.expr("vec_id % 100 = 0"))


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS codes
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.codes, b.codes) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
), negative AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND {LEAST_PERCENT} * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= {NEGATIVES}
"""
