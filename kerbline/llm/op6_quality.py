"""Quality rules with the perplexity of a modified Kneser-Ney n-gram model.

Symbols are the bytes of a text's words in lower case (A-Z), joined by one space; n-grams run across
words. Texts are dealt to two halves by a digest, copies to the same half, and each half is judged by the
model of the other: no text vouches for itself. Spark counts the 5-grams of all texts. All further numbers are sums over distinct n-grams and stay
in Spark: continuation counts for the lower orders, the three discounts of each order, and each
context's weight for the next lower order. N-grams are kept whole (40 bits), so a lookup is exact whatever
the corpus. There are two plans with equal results. Up to `spark.kerbline.modelRows` distinct n-grams the
model goes to every task as sorted arrays, looked up by binary search. A larger one stays in Spark: the
probability of each distinct 5-gram of the texts is joined together order by order, and joined to blocks
of texts by the distinct 5-grams of a block. No key has more than 256 rows there, or one for each block.
An order whose estimated discounts are not strictly between 0 and their counts (repeated texts cause this)
takes 0.5, 1 and 1.5.

A text's score is its mean negative log probability per byte. Each language has a band around the middle
half of its texts: quartiles minus and plus three times their distance, and more for a text of few words,
whose mean strays more. Texts outside are rejected, the unusual ones above, the overly regular ones below.
Texts without a language share a band.

Null texts have no words. Texts with fewer than 20 words, or with over 30 % of their words in repeated
8-word windows, fail whatever their perplexity, and do not shape the bands. Repeated rows count each.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbline.llm import words as W
from kerbline.plans.durable import attach, durable
from kerbline.plans.limits import limit

NAME = "op6_quality"
ORDER = 5
WINDOW = 8
#: Bytes of text measured at once; a longer text is measured alone and whole.
PART = W.SLICE // 4
#: 5-grams that a task gathers before it adds them up, and passes them on if half are distinct.
HELD = 1_000_000
#: Bytes of text in a block that is joined with its probabilities.
BLOCK = 2 * W.SLICE
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent
#: Width of the bands in quartile distances, and the steps of the histogram the quartiles come from.
REACH = 3.0
STEP = 0.001
#: The least distance of a band's borders from the quartiles, in nats a byte.
LEAST_REACH = 0.15
#: A mean over few words strays more: the reach grows with sqrt(FEW / words).
FEW = 50

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
PAD = b" " * (ORDER - 1)


def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 5-gram that ends at each symbol of the texts, packed in 40 bits, and where texts begin."""
    plain = [b" ".join(t.lower().split()) + b" " if t else b"" for t in texts]
    sizes = np.array([len(p) for p in plain], np.int64)
    data = np.frombuffer(PAD + PAD.join(plain), np.uint8).astype(np.uint64)
    if len(data) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    codes = np.zeros(len(data) - ORDER + 1, np.uint64)
    for k in range(ORDER):
        codes = codes << np.uint64(8) | data[k : len(codes) + k]
    # Between two texts lie ORDER - 1 places that end in padding.
    begins = np.concatenate([[0], np.cumsum(sizes)])
    kept = np.repeat(np.arange(len(sizes)) * (ORDER - 1), sizes) + np.arange(begins[-1])
    return codes[kept], begins


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[bytes]]]:
    data, offsets = W.buffers(column)
    for begin, end in W.slices(offsets, PART):
        own = offsets[begin : end + 1]
        held = data[own[0] : own[-1]]
        own = own - own[0]
        yield begin, end, held, own, [held[a:b].tobytes() for a, b in zip(own[:-1], own[1:], strict=True)]


def half(text: bytes) -> int:
    return zlib.crc32(text) & 1


def _halved(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed 5-grams with the text's half above them, each one once; its places; where texts begin."""
    codes, begins = _stream(texts)
    halves = np.array([half(t) for t in texts], np.uint64)
    marked = codes | np.repeat(halves, np.diff(begins)) << np.uint64(8 * ORDER)
    distinct, back = np.unique(marked, return_inverse=True)
    return distinct, back, begins


def count_grams(docs: DataFrame) -> DataFrame:
    """Counts of all 5-grams: the half they help to judge, gram (packed), n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for *_, texts in _texts(batch["text"]):
                codes, back, _ = _halved(texts)
                held.append((codes, np.bincount(back, minlength=len(codes)).astype(np.int32)))
                size += len(codes)
                if size > HELD:
                    held = [_merged(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield _pairs(*held[0])
                        held, size = [], 0
        if held:
            yield _pairs(*_merged(held))

    def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, at = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
        return grams, np.bincount(at, np.concatenate([n for _, n in held]), len(grams)).astype(np.int64)

    def _pairs(grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        judges = 1 - (grams >> np.uint64(8 * ORDER)).astype(np.int32)
        plain = grams & np.uint64(2 ** (8 * ORDER) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(judges), pa.array(plain.view(np.int64)), pa.array(counts)], ["half", "gram", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "half int, gram long, n long")
    return counted.groupBy("half", "gram").agg(F.sum("n").alias("n"))


#: Discounts of counts 1, 2 and 3 or more where the estimates are not usable.
PLAIN_CUTS = (0.5, 1.0, 1.5)


def usable(cuts: Sequence[float]) -> bool:
    """Whether each count keeps a share and each context a weight for the next lower order."""
    return all(0 < cut < k for k, cut in enumerate(cuts, 1))


def _discounts(grams: DataFrame) -> list[list[float]]:
    """For each half, the discounts of counts 1, 2 and 3 or more, from how many n-grams have counts 1 to 4.

    Corpora with repeated texts have too few small counts: an estimate can leave the range between 0 and
    its count. An order with such an estimate takes PLAIN_CUTS instead, so no byte has probability 0.
    """
    rows = grams.groupBy("half").agg(
        *[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    )
    out = [list(PLAIN_CUTS), list(PLAIN_CUTS)]
    for row in rows.collect():  # two rows
        n = [row[f"n{k}"] for k in (1, 2, 3, 4)]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            cuts = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
            if usable(cuts):
                out[row.half] = cuts
    return out


class Model:
    """For each order, sorted n-grams and values: shares of n-grams, and weights of contexts."""

    def __init__(self):
        self.shares: list[tuple[np.ndarray, np.ndarray]] = []
        self.weights: list[tuple[np.ndarray, np.ndarray]] = []
        self.bottom = 1.0

    @staticmethod
    def arrays(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Packed n-grams of one order in order, with their values."""
        ranked = np.argsort(codes)
        return codes[ranked].view(np.uint64), values[ranked].astype(np.float32)

    @staticmethod
    def look(arrays: tuple[np.ndarray, np.ndarray], codes: np.ndarray, absent: float) -> np.ndarray:
        keys, values = arrays
        if not len(keys):
            return np.full(len(codes), absent)
        ranked = np.argsort(codes)
        asked = codes[ranked]
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        out = np.empty(len(codes))
        out[ranked] = np.where(keys[at] == asked, values[at], absent)
        return out

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of packed 5-grams after the bytes before it."""
        p = np.full(len(codes), self.bottom / 256)
        for order in range(1, ORDER + 1):
            gram = codes & np.uint64(2 ** (8 * order) - 1)
            if order > 1:
                p *= self.look(self.weights[order - 1], gram >> np.uint64(8), 1.0)
            p += self.look(self.shares[order - 1], gram, 0.0)
        return np.log(p)


@dataclass
class Tables:
    """The models of both halves, order by order: shares (half, gram, share), weights (half, gram, weight).

    The gram of a weight is a context. `grams` has the counted 5-grams, `rows` is how many n-grams there are.
    """

    grams: DataFrame
    rows: int
    shares: list[DataFrame] = field(default_factory=list)
    weights: list[DataFrame | None] = field(default_factory=list)
    bottoms: list[float] = field(default_factory=lambda: [1.0, 1.0])


def tables(docs: DataFrame) -> Tables:
    """Shares and weights of all n-grams; the half of a row is the half that it helps to judge."""
    grams = durable(count_grams(docs))
    orders = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):
        # How many different bytes come before: the continuation count.
        shorter = F.col("gram").bitwiseAND(2 ** (8 * order) - 1)
        orders[order] = durable(
            orders[order + 1].groupBy("half", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        )
    out = Tables(grams, sum(found.count() for found in orders.values()))
    for order in range(1, ORDER + 1):
        found = orders[order]
        cuts = F.array(*[F.array(*map(F.lit, cut)) for cut in _discounts(found)])
        cut = F.get(F.get(cuts, F.col("half")), F.least(F.col("n"), F.lit(3)).cast("int") - 1)
        held = found.select("half", "gram", F.shiftright("gram", 8).alias("context"), "n", cut.alias("cut"))
        contexts = held.groupBy("half", "context").agg(
            F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight")
        )
        share = ((F.col("n") - F.col("cut")) / F.col("total")).cast("float").alias("share")
        out.shares.append(attach(held, contexts, ["half", "context"]).select("half", "gram", share))
        if order > 1:
            weight = F.col("weight").cast("float").alias("weight")
            out.weights.append(contexts.select("half", F.col("context").alias("gram"), weight))
        else:
            out.weights.append(None)
            for row in contexts.collect():  # two rows
                out.bottoms[row.half] = row.weight
    return out


def train(docs: DataFrame) -> list[Model]:
    """The models that judge each half, as arrays of all their n-grams."""
    return _fetched(tables(docs))


def _fetched(held: Tables) -> list[Model]:
    models = [Model(), Model()]
    for model, bottom in zip(models, held.bottoms, strict=True):
        model.bottom = bottom
    for shares, weights in zip(held.shares, held.weights, strict=True):
        for name, table in (("shares", shares), ("weights", weights)):
            if table is None:
                arrays = [(np.zeros(0, np.uint64), np.zeros(0, np.float32))] * 2
            else:
                found = table.toArrow()
                halves, codes, values = (found[c].to_numpy() for c in range(3))
                arrays = [Model.arrays(codes[halves == half], values[halves == half]) for half in (0, 1)]
            for model, own in zip(models, arrays, strict=True):
                getattr(model, name).append(own)
    return models


def probabilities(held: Tables, grams: DataFrame) -> dict[int, DataFrame]:
    """Probability of the last byte of 5-grams (half, gram; each once): half, gram, p, for every order.

    The same sums as in Model.log_probabilities, in the same order, by joins.
    """
    asked, out = {ORDER: grams}, {}

    def shorter(order: int) -> Column:
        return F.col("gram").bitwiseAND(2 ** (8 * order) - 1)

    for order in range(ORDER - 1, 0, -1):
        asked[order] = durable(asked[order + 1].select("half", shorter(order).alias("gram")).distinct())
    bottoms = F.array(*[F.lit(bottom / 256) for bottom in held.bottoms])
    lower = None
    for order in range(1, ORDER + 1):
        found = asked[order].join(held.shares[order - 1], ["half", "gram"], "left")
        share = F.coalesce(F.col("share").cast("double"), F.lit(0.0))
        if lower is None:
            p = F.get(bottoms, F.col("half")) + share
        else:
            weights = held.weights[order - 1].withColumnRenamed("gram", "context")
            found = (
                found.withColumns({"context": F.shiftright("gram", 8), "shorter": shorter(order - 1)})
                .join(weights, ["half", "context"], "left")
                .join(lower.select("half", F.col("gram").alias("shorter"), "p"), ["half", "shorter"])
            )
            p = F.col("p") * F.coalesce(F.col("weight").cast("double"), F.lit(1.0)) + share
        lower = out[order] = durable(found.select("half", "gram", p.alias("p")))
    return out


def _repeated(found: W.Words) -> np.ndarray:
    """Words of each text that lie in an 8-word window found twice or more in the text."""
    hashes, n = found.hashes(), len(found.first) - 1
    inside = W.inner(found.first, WINDOW, len(hashes))
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(n, np.int64)
    owners = found.owners().astype(np.uint64)
    windows = W.mix(W.grams(hashes, WINDOW)[at] + owners[at] * np.uint64(W.BASE))
    _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
    edges = np.zeros(len(hashes) + 1, np.int64)
    again = at[counts[back] > 1]
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
    return np.diff(hit[found.first])


def _duplicate_lines(text: bytes) -> int:
    seen, count = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            count += 1
        elif line.strip():
            seen.add(line)
    return count


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, nats double"
NAMES = [m.split()[0] for m in MEASURES.split(", ")]


def _measured(column: pa.Array, logs: Callable[[np.ndarray], np.ndarray]) -> list[pa.Array]:
    """The measures of a column of texts; `logs` gives log probabilities of 5-grams marked by their half."""

    def one() -> Iterator[tuple]:
        for _, _, data, offsets, texts in _texts(column):
            found = W.find(data, offsets, W.SPACED)
            chars = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & W.SPACED[data])])
            symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
            distinct, back, begins = _halved(texts)
            sums = np.concatenate([[0.0], np.cumsum(logs(distinct)[back])])
            sizes = np.diff(begins)
            words = found.counts()
            lines = np.array([_duplicate_lines(t) for t in texts], np.int64)
            loss = -(sums[begins[1:]] - sums[begins[:-1]]) / np.maximum(sizes, 1)
            yield (
                words,
                np.diff(chars[offsets]),
                np.diff(symbols[offsets]),
                lines,
                _repeated(found),
                np.where(words > 0, loss, np.nan),
            )

    parts = list(one())
    arrays = [
        np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64 if k < 5 else float)
        for k in range(len(NAMES))
    ]
    return [pa.array(a, from_pandas=True) for a in arrays]


def measures(text: Column, models) -> Column:
    """Struct of the base numbers of a text and `nats`, its mean loss per byte (null without words).

    `models` is a broadcast pair of models.
    """

    def logs(distinct: np.ndarray) -> np.ndarray:
        middle = np.searchsorted(distinct, np.uint64(1 << 8 * ORDER))
        plain = distinct & np.uint64((1 << 8 * ORDER) - 1)
        parts = zip(models.value, (plain[:middle], plain[middle:]), strict=True)
        return np.concatenate([model.log_probabilities(own) for model, own in parts])

    def over(column: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_measured(column, logs), NAMES)

    return F.arrow_udf(over, MEASURES)(text)


def _numbered(text: Column) -> Column:
    """Number of a row's block: texts of at most BLOCK bytes that follow each other, or one longer text."""
    number = numbers()

    def over(column: pa.Array) -> pa.Array:
        _, offsets = W.buffers(column)
        first = TaskContext.get().partitionId() << 32
        sizes = [(first | next(number), end - begin) for begin, end in W.slices(offsets, BLOCK)]
        return pa.array(np.repeat([b for b, _ in sizes], [n for _, n in sizes]).astype(np.int64))

    return F.arrow_udf(over, "long").asNondeterministic()(text)


def _joined_measures(docs: DataFrame, held: Tables, own: list[str]) -> DataFrame:
    """The named columns with the measures of each text, for a model of any size."""
    blocks = durable(docs.withColumn("_block", _numbered(F.col("text"))))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch["_block"].to_numpy()
            cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1)).tolist() if len(block) else []
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                texts = [t for *_, part in _texts(batch["text"].slice(begin, end - begin)) for t in part]
                marked, _, _ = _halved(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(marked), block[begin])),
                        pa.array((marked >> np.uint64(8 * ORDER)).astype(np.int32)),
                        pa.array((marked & np.uint64((1 << 8 * ORDER) - 1)).view(np.int64)),
                    ],
                    ["of", "half", "gram"],
                )

    spelled = blocks.select("_block", "text").mapInArrow(spell, "of long, half int, gram long")
    asked = held.grams.select((1 - F.col("half")).alias("half"), "gram")
    facts = spelled.join(probabilities(held, asked)[ORDER], ["half", "gram"])

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        half, gram, p = (right[c].to_numpy() for c in ("half", "gram", "p"))
        keys = gram.view(np.uint64) | half.astype(np.uint64) << np.uint64(8 * ORDER)
        ranked = np.argsort(keys)
        keys, values = keys[ranked], np.log(p[ranked])

        def logs(distinct: np.ndarray) -> np.ndarray:
            if not len(distinct):
                return np.zeros(0)
            at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
            if (keys[at] != distinct).any():
                raise ValueError("a 5-gram of a block has no probability")
            return values[at]

        out = left.select(own)
        for name, values_of in zip(NAMES, _measured(left["text"].combine_chunks(), logs), strict=True):
            out = out.append_column(name, values_of)
        return out

    schema = StructType([blocks.schema[c] for c in own] + StructType.fromDDL(MEASURES).fields)
    return blocks.groupBy("_block").cogroup(facts.groupBy("of")).applyInArrow(total, schema)


def bands(measured: DataFrame) -> DataFrame:
    """Quartiles of each language and the reach beyond them, from all texts that pass the base rules."""
    bins = (
        measured.filter(~F.col("base_failed"))
        .groupBy("lang", F.round(F.col("nats") / STEP).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    quartiles = bins.groupBy("lang").agg(F.expr("percentile(bin, array(0.25, 0.75), n)").alias("q"))
    low, high = F.col("q")[0] * STEP, F.col("q")[1] * STEP
    reach = F.greatest((high - low) * REACH, F.lit(LEAST_REACH))
    return quartiles.select("lang", low.alias("_low"), high.alias("_high"), reach.alias("_reach"))


def judged(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Documents (doc_id, text, lang) with the measures, base_failed, low, high and kept.

    Columns of these names are replaced, all others stay, whatever their names; `lang` is a text or null.
    """
    spark = docs.sparkSession
    made = [*NAMES, "base_failed", "low", "high", "kept"]
    dropped = made if keep_text else [*made, "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in dropped]).alias("row")
    plain = docs.select(row, "text", "lang")
    held = tables(plain)
    failed = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    if held.rows <= limit(spark, "modelRows"):
        models = spark.sparkContext.broadcast(_fetched(held))
        found = plain.select("row", "lang", measures(F.col("text"), models).alias("m")).select("row", "lang", "m.*")
    else:
        found = _joined_measures(plain, held, ["row", "lang"])
    # An empty name stands for no language, so that nulls meet in the join.
    measured = durable(found.withColumns({"lang": F.coalesce("lang", F.lit("")), "base_failed": F.expr(failed)}))
    reach = F.expr(f"_reach * (1 + sqrt({FEW} / greatest(n_words, 1)))")
    return (
        attach(measured, bands(measured), ["lang"])
        .withColumns({"low": F.col("_low") - reach, "high": F.col("_high") + reach})
        .withColumn("kept", F.expr("NOT base_failed AND coalesce(nats BETWEEN low AND high, true)"))
        .select("row.*", *made)
    )


def reject(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns."""
    plain = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), "doc_id", "text", F.col("lang").cast("string").alias("lang")
    )
    return judged(plain, keep_text=False).filter("kept").select("_row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    return judged(docs, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "nats", "low", "high",
    )
