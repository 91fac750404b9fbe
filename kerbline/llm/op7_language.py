"""Language identification by unigram pieces with all segmentations summed.

The pieces are a fixed public vocabulary; each language has a probability for every piece. A text is
its runs of letters in lower case, each with the mark of a word's begin. A word's probability in a
language is the sum over all ways to cut it into pieces of the product of their probabilities, found by
the forward algorithm; a text's is the product over its words. A character outside the vocabulary
counts as the piece of its first UTF-8 byte.

Training is expectation maximisation: Spark counts words per language over all labelled texts, then each
round computes expected piece counts by the forward and backward algorithm in tasks over those words,
and sums them by piece. What reaches the driver is one number per piece and language, and so is what
goes to the tasks.

Texts that are null or have no letter are `und` with score 0, and so is all if no labelled text was
given. Between languages of equal probability the first name wins.
"""

from __future__ import annotations

import functools
import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm import words as W
from kerbline.plans.durable import durable

NAME = "op7_language"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ROUNDS = 3
#: Expected count every piece has in every language before training.
SMOOTHING = 0.01
BEGIN = "▁"
#: Longer words are scored one by one, with rescaling against underflow.
LONG = 30
#: Distinct words scored at once, those a worker remembers, and texts handled at once.
BLOCK, REMEMBERED, TEXTS = 20_000, 400_000, 256


@functools.cache
def letters() -> re.Pattern:
    """Words: letters, and the combining marks that follow them (vowel signs, accents of decomposed text)."""
    marks = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Mn", "Mc")]
    held = set(marks)
    firsts, lasts = ([c for c in marks if c + step not in held] for step in (-1, 1))
    ranges = "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(firsts, lasts, strict=True))
    return re.compile(rf"(?:[^\W\d_]++[{ranges}]*+)++")


#: Words of texts in which no mark can be: all are from U+0300 on. A class of two ranges is much faster than that of all marks.
_PLAIN, _MAY_BE_MARK = re.compile(r"[^\W\d_]+"), re.compile("[\u0300-\U0010ffff]")


def words_of(text: str) -> list[str]:
    """The words of a text, in lower case."""
    text = text.lower()
    return (letters() if _MAY_BE_MARK.search(text) else _PLAIN).findall(text)


class Pieces:
    """A vocabulary as a tree of characters: each leads to the piece that ends there, or -1, and further on."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        if self.size > 1 << 16:
            raise ValueError("piece ids need 16 bits")
        self.root: dict[str, list] = {}
        self.byte = [0] * 256
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i)):
                below = self.root
                for c in piece:
                    step = below.setdefault(c, [-1, {}])
                    below = step[1]
                step[0] = i

        self._number()

    def _number(self) -> None:
        """The tree as arrays: nodes are numbered, a node and a character lead to a node; each has its piece."""
        ends, steps, below = [-1], [], [(0, self.root)]
        while below:
            node, branches = below.pop()
            for c, (piece, further) in branches.items():
                steps.append((node << 21 | ord(c), len(ends)))
                if further:
                    below.append((len(ends), further))
                ends.append(piece)
        self.ends, self.bytes = np.array(ends, np.int32), np.array(self.byte, np.int64)
        self.steps = W.Lookup(*np.array(steps, np.int64).reshape(-1, 2).T, absent=-1)

    def arcs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All pieces inside the words: word, begin, end, piece. Place 0 is the mark of the begin.

        All places of all words go down the tree side by side, a character a round.
        """
        text = np.frombuffer("".join([BEGIN + w for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        lasts = np.cumsum(sizes)
        of = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(text)) - (lasts - sizes)[of]
        node = self.steps(text)
        # One character alone is a piece, or else its first byte.
        alone = np.where(node >= 0, self.ends[node], -1)
        rest = np.flatnonzero(alone < 0)
        alone[rest] = self.bytes[_first_bytes(text[rest])]
        at = np.arange(len(text))
        begins, ends, found = [at], [at + 1], [alone]
        left = lasts[of] - at
        long = 1
        while True:
            going = (node >= 0) & (left > long)
            at, node, left = at[going], node[going], left[going]
            if not len(at):
                break
            node = self.steps(node.astype(np.int64) << 21 | text[at + long])
            long += 1
            hit = np.flatnonzero((node >= 0) & (self.ends[node] >= 0))
            begins.append(at[hit])
            ends.append(at[hit] + long)
            found.append(self.ends[node[hit]])
        begin, end, piece = map(np.concatenate, (begins, ends, found))
        order = np.argsort(begin, kind="stable")
        begin, end, piece = begin[order], end[order], piece[order].astype(np.int64)
        word, at = of[begin], place[begin]
        return word, at, at + end - begin, piece


def _first_bytes(codes: np.ndarray) -> np.ndarray:
    """The first UTF-8 byte of each code point."""
    return np.select(
        [codes < 0x80, codes < 0x800, codes < 0x10000], [codes, 0xC0 | codes >> 6, 0xE0 | codes >> 12], 0xF0 | codes >> 18
    )


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def spelled(word: str) -> str:
    """Only letters and marks; Python's class of word characters has some numbers too. Marks alone are no word."""
    if word.isalpha():
        return word
    kept = "".join(c for c in word if c.isalpha() or unicodedata.category(c) in ("Mn", "Mc"))
    return kept if any(map(str.isalpha, kept)) else ""


def _sweep(n, w, begin, end, weight, back: bool) -> np.ndarray:
    """Forward (or backward) sums for words of at most LONG letters; weight: per arc (and language)."""
    depth = int(end.max(initial=0)) + 1
    sums = np.zeros((n, depth, *weight.shape[1:]))
    if back:
        begin, end = end, begin
        sums[np.arange(n), _last(n, w, begin)] = 1.0
    else:
        sums[:, 0] = 1.0
    # Arcs come by word; a stable sort of narrow numbers keeps that order.
    order = np.argsort(end.astype(np.uint8), kind="stable")
    w, begin, end, weight = w[order], begin[order], end[order], weight[order]
    cuts = np.flatnonzero(np.diff(end)) + 1
    groups = list(zip([0, *cuts], [*cuts, len(end)], strict=True)) if len(end) else []
    for low, high in reversed(groups) if back else groups:
        flow = sums[w[low:high], begin[low:high]] * weight[low:high]
        heads = np.flatnonzero(np.diff(w[low:high], prepend=-1))
        sums[w[low:high][heads], end[low]] += np.add.reduceat(flow, heads, axis=0)
    return sums


def _last(n: int, w: np.ndarray, end: np.ndarray) -> np.ndarray:
    last = np.zeros(n, np.int64)
    np.maximum.at(last, w, end)
    return last


def _long(held: Pieces, word: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums of a long word, each place scaled to a largest value of 1, and the log scales."""
    _, begin, end, piece = held.arcs([word])
    n = len(word) + 1
    sums, scale = np.zeros((n + 1, table.shape[1])), np.zeros(n + 1)
    sums[0] = 1.0
    order = np.argsort(end, kind="stable")
    begin, end, piece = begin[order], end[order], piece[order]
    cuts = np.searchsorted(end, np.arange(1, n + 2))
    for j in range(1, n + 1):
        low, high = cuts[j - 1], cuts[j]
        i = begin[low:high]
        total = (sums[i] * np.exp(scale[i] - scale[j - 1])[:, None] * table[piece[low:high]]).sum(0)
        most = total.max()
        sums[j], scale[j] = total / most, scale[j - 1] + np.log(most)
    return sums, scale


def log_probabilities(held: Pieces, words: list[str], table: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language; words without letters have 0."""
    out = np.zeros((len(words), table.shape[1]))
    if not table.shape[1]:
        return out
    short = [k for k, x in enumerate(words) if 0 < len(x) <= LONG]
    for at in range(0, len(short), BLOCK):
        block = short[at : at + BLOCK]
        w, begin, end, piece = held.arcs([words[k] for k in block])
        sums = _sweep(len(block), w, begin, end, table[piece], False)
        out[block] = np.log(sums[np.arange(len(block)), [len(words[k]) + 1 for k in block]])
    for k, word in enumerate(words):
        if len(word) > LONG:
            sums, scale = _long(held, word, table)
            with np.errstate(divide="ignore"):
                out[k] = np.log(sums[-1]) + scale[-1]
    return out


@dataclass
class Model:
    """Languages in order of names, and each one's probability of every piece."""

    languages: list[str]
    table: np.ndarray
    path: str


def word_counts(docs: DataFrame) -> DataFrame:
    """Words of all labelled texts by language: lang, word, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], int] = {}

        def rows() -> pa.RecordBatch:
            langs, words = zip(*held, strict=True) if held else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())],
                ["lang", "word", "n"],
            )

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for word in words_of(text):
                    held[lang, word] = held.get((lang, word), 0) + 1
                if len(held) > REMEMBERED:
                    yield rows()
                    held.clear()
        yield rows()

    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = known.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def expected(counts: DataFrame, model: Model) -> np.ndarray:
    """One round of expectation: expected count of every piece in every language."""
    place = {lang: k for k, lang in enumerate(model.languages)}
    table, path = model.table, model.path

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pieces(path)
        total = np.zeros(table.shape)
        for batch in batches:
            langs = np.array([place[x] for x in batch["lang"].to_pylist()], np.int64)
            words = [spelled(x) for x in batch["word"].to_pylist()]
            n = batch["n"].to_numpy().astype(float)
            # A long word's pieces are counted in parts, which only moves a few cuts.
            parts = [
                (x[at : at + LONG], k) for k, x in enumerate(words) for at in range(0, len(x), LONG)
            ]
            for at in range(0, len(parts), BLOCK):
                block = parts[at : at + BLOCK]
                of = np.array([k for _, k in block])
                w, begin, end, piece = held.arcs([x for x, _ in block])
                p = table[piece, langs[of[w]]]
                ahead = _sweep(len(block), w, begin, end, p, False)
                behind = _sweep(len(block), w, begin, end, p, True)
                whole = behind[np.arange(len(block)), 0]
                share = ahead[w, begin] * p * behind[w, end] / whole[w] * n[of[w]]
                np.add.at(total, (piece, langs[of[w]]), share)
        at, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(lang), pa.array(total[at, lang])], ["piece", "lang", "n"]
        )

    found = (
        counts.mapInArrow(expect, "piece long, lang long, n double")
        .groupBy("piece", "lang")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    out = np.zeros(table.shape)
    out[found["piece"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
    return out


def train(docs: DataFrame, rounds: int = ROUNDS, path: str = PIECES) -> Model:
    """Piece probabilities of every language in `docs` (text, lang); rows without either are left out."""
    counts = durable(word_counts(docs))
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    size = pieces(path).size
    model = Model(languages, np.full((size, len(languages)), 1.0 / size), path)
    for _ in range(rounds if languages else 0):
        n = expected(counts, model) + SMOOTHING
        model.table = n / n.sum(axis=0)
    return model


class Remembered:
    """Log probabilities of the words a worker has met, for the model it used last."""

    def __init__(self):
        self.mark: bytes = b""
        self._clear(0)

    def _clear(self, languages: int) -> None:
        self.known: dict[str, int] = {}
        self.logs = np.zeros((REMEMBERED, languages))
        self.lettered = np.zeros(REMEMBERED, bool)

    def rows(self, texts: list[list[str]], table: np.ndarray, held: Pieces, mark: bytes) -> list[np.ndarray]:
        """For each text, the rows of its words in `logs`."""
        wanted = dict.fromkeys(chain.from_iterable(texts))
        fresh = [w for w in wanted if w not in self.known]
        if mark != self.mark or len(self.known) + len(fresh) > len(self.logs):
            self._clear(table.shape[1])
            self.mark, fresh = mark, list(wanted)
            if len(fresh) > len(self.logs):
                self.logs, self.lettered = np.zeros((len(fresh), table.shape[1])), np.zeros(len(fresh), bool)
        begin = len(self.known)
        plain = [spelled(w) for w in fresh]
        self.logs[begin : begin + len(fresh)] = log_probabilities(held, plain, table)
        self.lettered[begin : begin + len(fresh)] = [len(w) > 0 for w in plain]
        self.known.update(zip(fresh, range(begin, begin + len(fresh)), strict=True))
        find = self.known.__getitem__
        return [np.fromiter(map(find, t), np.int64, len(t)) for t in texts]


_remembered = Remembered()


def _verdicts(texts: list[str | None], model: Model, mark: bytes) -> Iterator[tuple[str, float]]:
    words = [words_of(t or "") for t in texts]
    for at in _remembered.rows(words, model.table, pieces(model.path), mark):
        if not model.languages or not _remembered.lettered[at].any():
            yield "und", 0.0
            continue
        total = _remembered.logs[at].sum(axis=0)
        best = int(total.argmax())
        yield model.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def identified(text: Column, model: Model) -> Column:
    """Struct of lang_pred and score for a text column."""
    mark = hashlib.blake2b(model.table.tobytes()).digest() + repr(model.languages).encode()

    def over(column: pa.Array) -> pa.Array:
        names, scores = [], []
        for at in range(0, len(column), TEXTS):
            for name, score in _verdicts(column.slice(at, TEXTS).to_pylist(), model, mark):
                names.append(name)
                scores.append(score)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
        )

    return F.arrow_udf(over, "lang_pred string, score double")(text)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and score; existing columns of these names are replaced."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "_found")]
    found = docs.withColumn("_found", identified(F.col(f"`{text}`"), model))
    return found.select(*[f"`{c}`" for c in kept], "_found.lang_pred", "_found.score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from two of three folds."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = train(docs.filter(~F.coalesce(held_out, F.lit(False))))
    asked = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return predict(asked, model).drop("text")
