"""Benchmark decontamination by winnowing.

Words are runs of letters and digits with A-Z in lower case. An item's windows are its runs of 13
words; an item of fewer words is one window. Of every 6 neighbouring 8-word hashes of a text, the
smallest (the rightmost among equals) is kept as a fingerprint. Two texts that share 13 words share 6
such hashes in a row, so they keep a common fingerprint at the same place: no shared window is
missed. Items of fewer than 13 words are looked for by their whole length instead.

1. Each task keeps those fingerprints of its documents that may be in the benchmark, judged by a bit
   set of fixed size, and the word hashes of documents that have any.
2. Document and benchmark fingerprints are joined; what remains are pairs of text and item with the
   distance between their places.
3. Each hit is extended to both sides by comparing words (64-bit hashes) along that distance; runs as
   long as a window count.

Copies of a text are looked up once. Null texts have no words. A document without a hit has no items.
An item with a null id marks words as hit but is not listed; items that share an id count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm import words as W
from kerbline.plans.durable import attach, durable

NAME = "op2_winnowing"
WINDOW = 13
GRAM = 8
#: neighbouring hashes of which one is kept; GRAM + KEEP - 1 = WINDOW
KEEP = WINDOW - GRAM + 1
#: The bit set has 2**BITS bits, 8 MB, whatever the benchmark's size.
BITS = 26

PRINTS = "array<struct<print:bigint,at:int>>"
PRINTS_ARROW = pa.list_(pa.struct([("print", pa.int64()), ("at", pa.int32())]))


def winnow(hashes: np.ndarray, valid: np.ndarray, keep: int = KEEP) -> np.ndarray:
    """Places of the kept hashes: in each run of `keep`, the smallest, the rightmost among equals."""
    n = len(hashes) - keep + 1
    if n <= 0:
        return np.flatnonzero(valid)
    masked = np.where(valid, hashes, np.uint64(2**64 - 1))
    least, place = masked[:n].copy(), np.arange(n)
    for j in range(1, keep):
        later = masked[j : j + n]
        smaller = later <= least
        least[smaller] = later[smaller]
        place[smaller] = np.flatnonzero(smaller) + j
    chosen = np.zeros(len(hashes), bool)
    chosen[place] = True
    return np.flatnonzero(chosen & valid)


def _salted(hashes: np.ndarray, length: int) -> np.ndarray:
    return W.mix(hashes ^ np.uint64(length * 0xA24BAED4963EE407 % 2**64))


def prints(found: W.Words, hashes: np.ndarray, short: tuple[int, ...]):
    """Fingerprints of texts and their places: winnowed ones and whole runs of each short length."""
    hashed, places = [], []
    for length in (GRAM, *short):
        runs = W.grams(hashes, length)
        valid = W.inner(found.first, length, len(hashes))
        # Short lengths are salted apart from the winnowed ones, which may have the same length.
        if length == GRAM and not places:
            at, salt = winnow(runs, valid), 0
        else:
            at, salt = np.flatnonzero(valid), length
        hashed.append(_salted(runs[at], salt))
        places.append(at)
    return np.concatenate(hashed), np.concatenate(places)


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, found in W.lowered(batch["text"], W.ALNUM):
            hashes = found.hashes()
            ids = batch["item_id"].slice(begin, end - begin)
            rows = []
            for d, item in enumerate(ids.to_pylist()):
                own = hashes[found.first[d] : found.first[d + 1]]
                n = len(own)
                if not n:
                    continue
                one = W.Words(found.data, found.offsets, None, None, np.array([0, n]))
                if n < WINDOW:
                    values, at = _salted(W.grams(own, n), n), np.array([0])
                else:
                    values, at = prints(one, own, ())
                rows.append(
                    {
                        "item_id": item,
                        "n": n,
                        "item_words": own.tobytes(),
                        "prints": [
                            {"print": p, "at": a}
                            for p, a in zip(values.view(np.int64).tolist(), at.tolist(), strict=True)
                        ],
                    }
                )
            yield pa.RecordBatch.from_pylist(
                rows,
                pa.schema(
                    [
                        ("item_id", pa.string()),
                        ("n", pa.int32()),
                        ("item_words", pa.binary()),
                        ("prints", PRINTS_ARROW),
                    ]
                ),
            )


def _bit_set(items: DataFrame) -> np.ndarray:
    """2**BITS bits, set where a benchmark fingerprint falls; at most 2**(BITS-6) rows are fetched."""
    cell = F.expr(f"print & {2**BITS - 1}L")
    rows = (
        items.select(F.explode("prints.print").alias("print"))
        .select(F.shiftright(cell, 6).alias("at"), F.expr(f"1L << int(print & 63)").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    held = np.zeros(2 ** (BITS - 6), np.int64)
    held[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return held.view(np.uint64)


def _maybe(held: np.ndarray, values: np.ndarray) -> np.ndarray:
    cells = values & np.uint64(2**BITS - 1)
    return (held[cells >> np.uint64(6)] >> (cells & np.uint64(63))) & np.uint64(1) == 1


def _lists(values: pa.Array, owners: np.ndarray, n: int) -> pa.Array:
    sizes = np.bincount(owners, minlength=n)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def survivors(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: key of its text, word count, fingerprints that may hit, word hashes if any do."""
    held = _bit_set(items)
    lengths = items.filter(F.col("n") < WINDOW).select("n").distinct().collect()  # at most 12
    short = tuple(sorted(r.n for r in lengths))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, found in W.lowered(batch["text"], W.ALNUM):
                n = end - begin
                hashes = found.hashes()
                values, at = prints(found, hashes, short)
                kept = np.flatnonzero(_maybe(held, values))
                values, at = values[kept], at[kept]
                owners = np.searchsorted(found.first, at, "right") - 1
                order = np.argsort(owners, kind="stable")
                values, at, owners = values[order], at[order], owners[order]
                pairs = pa.StructArray.from_arrays(
                    [
                        pa.array(values.view(np.int64)),
                        pa.array((at - found.first[owners]).astype(np.int32)),
                    ],
                    ["print", "at"],
                )
                some = set(owners.tolist())
                own = [
                    hashes[found.first[d] : found.first[d + 1]].tobytes() if d in some else None
                    for d in range(n)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(begin, n),
                        batch["text_key"].slice(begin, n),
                        pa.array(found.counts().astype(np.int64)),
                        _lists(pairs, owners, n),
                        pa.array(own, pa.binary()),
                    ],
                    ["doc_id", "text_key", "n_words", "prints", "words"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed(docs).select("doc_id", "text_key", "text").mapInArrow(
        scan, f"doc_id {kind}, text_key string, n_words long, prints {PRINTS}, words binary"
    )


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with a digest of the text; copies share it."""
    return docs.withColumn("text_key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def _runs(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal words of a text and an item, along the distance of a common fingerprint."""
    for batch in batches:
        out = {"text_key": [], "item_id": [], "start": [], "stop": []}
        for row in batch.to_pylist():
            text = np.frombuffer(row["words"], np.uint64)
            item = np.frombuffer(row["item_words"], np.uint64)
            shift = row["shift"]
            low, high = max(0, shift), min(len(text), len(item) + shift)
            same = text[low:high] == item[low - shift : high - shift]
            for a, b in _runs(same, min(WINDOW, len(item))):
                out["text_key"].append(row["text_key"])
                out["item_id"].append(row["item_id"])
                out["start"].append(low + a)
                out["stop"].append(low + b)
        yield pa.RecordBatch.from_pydict(
            out,
            pa.schema(
                [
                    ("text_key", pa.string()),
                    ("item_id", pa.string()),
                    ("start", pa.int32()),
                    ("stop", pa.int32()),
                ]
            ),
        )


def _covered(spans: str) -> str:
    """SQL: number of words in a union of spans, taken in order of their starts."""
    return f"""aggregate(array_sort({spans}), struct(0L AS n, 0 AS upto),
        (a, s) -> struct(a.n + greatest(0, s.stop - greatest(s.start, a.upto)) AS n,
                         greatest(a.upto, s.stop) AS upto), a -> a.n)"""


def scan(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, items, spans, contaminated.

    `docs` needs doc_id and text, `benchmark` item_id and text. `items` are the ids, as sorted strings,
    of items with a window in the document; `spans` are the runs of hit words, from word `start` up to
    word `stop`. A document is contaminated if at least one in twenty of its words is hit.
    """
    items = durable(
        benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(
            _item_prints, f"item_id string, n int, item_words binary, prints {PRINTS}"
        ).withColumn("item", F.monotonically_increasing_id())
    )
    seen = durable(survivors(docs, items))
    texts = seen.filter("words IS NOT NULL")
    ours = texts.select("text_key", F.inline("prints")).distinct()
    theirs = items.select("item", F.inline("prints").alias("print", "item_at"))
    pairs = (
        attach(ours, theirs, ["print"], "inner")
        .select("text_key", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    joined = attach(pairs, items.select("item", "item_id", "item_words"), ["item"], "inner").join(
        texts.select("text_key", "words").dropDuplicates(["text_key"]), "text_key"
    )
    hits = (
        joined.select("text_key", "item_id", "shift", "item_words", "words")
        .mapInArrow(_extend, "text_key string, item_id string, start int, stop int")
        .groupBy("text_key")
        .agg(
            F.array_sort(F.collect_set("item_id")).alias("items"),
            F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        )
        .withColumn("n_hit", F.expr(_covered("spans")))
    )
    return (
        attach(seen.select("doc_id", "text_key", "n_words"), hits, ["text_key"])
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns, whatever these are called."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    bad = scan(rows, benchmark).filter("contaminated").select("text_key").distinct()
    return attach(keyed(rows), bad, ["text_key"], "left_anti").select("row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark hits of every document."""
    found = scan(
        spark.read.parquet(f"{folder}/documents.parquet"),
        spark.read.parquet(f"{folder}/benchmark.parquet"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least({WINDOW}, len(w)) AS size
      FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
wins AS (
  SELECT DISTINCT item_id, size, list_slice(w, pos, pos + size - 1) AS win
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS pos FROM i)),
runs AS (
  SELECT doc_id, pos, size, list_slice(w, pos, pos + size - 1) AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos
        FROM d, (SELECT DISTINCT size FROM i))),
found AS (SELECT doc_id, pos, size, item_id FROM runs JOIN wins USING (size, win)),
words_hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
