"""Byte-level BPE: encode with a queue of merge ranks, decode by joining vocabulary strings.

A text is cut at the added tokens of the vocabulary file, the rest into words by the published
pattern of byte-level vocabularies. A word's bytes form a doubly linked list of symbols. A heap holds
the rank of every neighbouring pair that can merge; the lowest rank, leftmost first, is popped and
merged, and entries whose pair has changed since are skipped. That is n log n for a word of n bytes,
so a text without spaces does no harm. Short words keep a plain list of ranks instead of the heap. Words seen lately are kept in a table of bounded size.

A column of texts is cut in slices. Texts of ASCII and Latin letters are cut into words by classes of bytes,
which gives the pattern's words; Arrow numbers a slice's words, and the distinct ones are merged side by side,
each by its own lowest rank in every round. Other texts, and those with added tokens, are cut by the pattern
and merged one by one.

Null texts count as empty and have no ids. Empty texts have no ids. Other columns pass through; an
existing column of the output's name is replaced.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from kerbline.llm import words as W

NAME = "op8_bpe"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Words a task remembers; two generations are kept.
REMEMBERED = 300_000
#: Longer words are not remembered.
LONGEST = 48
#: Bytes of texts whose words are numbered at once.
SLICE = 4 * W.SLICE
#: Words of up to so many bytes are merged without a queue; a rank that no merge has.
SHORT, NONE = 40, 1 << 62
#: A rank that no merge has, in arrays.
LAST = 2**31 - 1

#: The published word pattern, for texts in which Python's classes agree with letters and numbers.
WORD = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)


#: What a look at every character has to find: separators, and all that Latin-1 leaves in doubt.
_DOUBT = re.compile("[\x1c-\x1f²³¹¼-¾Ā-\U0010ffff]")


@functools.cache
def _odd() -> frozenset[str]:
    """Characters on which Python's classes and the pattern's differ or may differ.

    Letter-like and other numbers count as numbers there, separators U+001C to U+001F are no white
    space, and unassigned code points may have been assigned in a later Unicode version.
    """
    return frozenset(
        chr(c)
        for c in range(sys.maxunicode + 1)
        if 0x1C <= c <= 0x1F or unicodedata.category(chr(c)) in ("Nl", "No", "Cn")
    )


def words(text: str) -> list[str]:
    """A text cut into words by the pattern."""
    if _DOUBT.search(text) and not _odd().isdisjoint(text):
        cut = ByteLevel(add_prefix_space=False).pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in cut]
    return WORD.findall(text)


#: Classes of bytes: white space, letters (with the bytes of U+00C0 to U+027F), digits, others.
WHITE, LETTER, DIGIT, OTHER = range(4)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = WHITE
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = LETTER
_CLASS[0x30:0x3A] = DIGIT
#: First bytes of what the classes do not cut: U+0080 to U+00BF and all from U+0280 on; U+00D7 and U+00F7 beside them.
_FOREIGN = np.zeros(256, bool)
_FOREIGN[[0xC2, *range(0xCA, 0x100)]] = True
#: What may follow an apostrophe, by its first byte.
_ENDINGS = {b: b"" for b in b"stmd"} | {ord("r"): b"e", ord("v"): b"e", ord("l"): b"l"}


def foreign(data: np.ndarray) -> np.ndarray:
    """Places of what the classes do not cut."""
    signs = ((data[1:] == 0x97) | (data[1:] == 0xB7)) & (data[:-1] == 0xC3)
    return np.concatenate([np.flatnonzero(_FOREIGN[data]), np.flatnonzero(signs)])


def starts_of(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pattern's words begin in texts without foreign bytes; `first` marks the begins of texts."""
    kind = _CLASS[data]
    starts = first.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # The last of some white space before a word stands alone; a blank belongs to the word.
    white = kind == WHITE
    alone = np.flatnonzero(white[:-1] & ~white[1:] & ~first[1:])
    starts[alone] = True
    starts[alone[data[alone] == 0x20] + 1] = False
    marks = np.flatnonzero(starts & (data == 0x27))
    n = len(data)
    for i in marks[(marks + 1 < n)].tolist():
        ending = _ENDINGS.get(int(data[i + 1]))
        if ending is None or first[i + 1]:
            continue
        j = i + 2
        if ending:
            if j == n or first[j] or data[j] != ending[0]:
                continue
            j += 1
        starts[i + 1] = False
        if j < n and not first[j] and kind[j] == LETTER:
            starts[j] = True
    return starts


def _alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, by rule.

    Printable Latin-1 characters stand for themselves, the others for U+0100 and up, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Merges and vocabulary strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, added = held["model"], held["added_tokens"]
        if held["normalizer"] or held["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is no byte-level vocabulary")
        if held["pre_tokenizer"]["add_prefix_space"] or any(
            t["single_word"] or t["lstrip"] or t["rstrip"] for t in added
        ):
            raise ValueError(f"{path} changes texts before they are cut")
        bytes_of = _alphabet()
        ids = model["vocab"]
        size = max([*ids.values(), *(t["id"] for t in added)]) + 1
        self.strings: list[bytes] = [b""] * size
        for shown, i in ids.items():
            self.strings[i] = bytes(bytes_of.get(c, 0x3F) for c in shown)
        self.added = {t["content"]: t["id"] for t in added}
        for content, i in self.added.items():
            self.strings[i] = content.encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.cut_bytes = re.compile(self.cut.pattern.encode())
        self.byte = [0] * 256
        for shown, b in bytes_of.items():
            self.byte[b] = ids[shown]
        #: for each left symbol, right symbol to rank; ids made by rank
        self.follow: list[dict[int, int]] = [{}] * size
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right = ids[a], ids[b]
            if not self.follow[left]:
                self.follow[left] = {}
            self.follow[left][right] = rank
            self.made.append(ids[a + b])
        # the same for many words at once: ranks of pairs, ranks of pairs of bytes, ids made, ids of bytes
        pairs = [(left << 32 | right, rank) for left, after in enumerate(self.follow) for right, rank in after.items()]
        self.rank = W.Lookup(*np.array(pairs, np.int64).reshape(-1, 2).T, absent=LAST)
        self.bytes = np.array(self.byte, np.int64)
        self.byte_rank = self.rank((self.bytes[:, None] << 32 | self.bytes).ravel())
        self.ids_made = np.array(self.made, np.int64)

    def merged(self, word: bytes) -> list[int]:
        """The ids of one word: merges by rank, the leftmost first among equals."""
        byte, follow, made = self.byte, self.follow, self.made
        symbol = [byte[b] for b in word]
        n = len(symbol)
        if n <= SHORT:
            return self._merged_short(symbol)
        shift = n.bit_length()  # a queue entry is a rank and, in its low bits, a place
        queue = []
        left = symbol[0]
        for i in range(1, n):
            right = symbol[i]
            rank = follow[left].get(right)
            if rank is not None:
                queue.append(rank << shift | i - 1)
            left = right
        if not queue:
            return symbol
        heapq.heapify(queue)
        push, pop, low = heapq.heappush, heapq.heappop, (1 << shift) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = pop(queue)
            i = entry & low
            j, left = after[i], symbol[i]
            if left < 0 or j == n:
                continue
            rank = entry >> shift
            if follow[left].get(symbol[j]) != rank:
                continue  # stale: the pair at this place has changed
            symbol[i] = new = made[rank]
            symbol[j] = -1
            after[i] = k = after[j]
            if k != n:
                before[k] = i
                rank = follow[new].get(symbol[k])
                if rank is not None:
                    push(queue, rank << shift | i)
            h = before[i]
            if h >= 0:
                rank = follow[symbol[h]].get(new)
                if rank is not None:
                    push(queue, rank << shift | h)
        return [s for s in symbol if s >= 0]


    def _merged_short(self, symbol: list[int]) -> list[int]:
        """The same merges for few symbols, where a look at all ranks costs less than a queue."""
        follow, made = self.follow, self.made
        ranks = [follow[a].get(b, NONE) for a, b in zip(symbol, symbol[1:], strict=False)]
        while ranks:
            rank = min(ranks)
            if rank == NONE:
                break
            i = ranks.index(rank)
            symbol[i] = new = made[rank]
            del symbol[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = follow[new].get(symbol[i + 1], NONE)
            if i:
                ranks[i - 1] = follow[symbol[i - 1]].get(new, NONE)
        return symbol


def merged_together(held: Vocabulary, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words `data[cuts[w]:cuts[w+1]]`, end to end, and each word's number of them.

    In every round each word merges its lowest rank, the leftmost first; words without one are done. Long words
    are merged by the queue.
    """
    sizes = np.diff(cuts)
    counts = np.zeros(len(sizes), np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []  # words and their ids, end to end
    for w in np.flatnonzero(sizes > SHORT).tolist():
        found = np.array(held.merged(data[cuts[w] : cuts[w + 1]].tobytes()), np.int64)
        counts[w] = len(found)
        done.append((np.array([w]), found))
    words = np.flatnonzero((sizes > 0) & (sizes <= SHORT))
    kept = np.repeat((sizes > 0) & (sizes <= SHORT), sizes)
    data, size = (data[kept], sizes[words]) if not kept.all() else (data, sizes[words])
    symbol = held.bytes[data]
    # A symbol's rank is that of its merge with the next one.
    rank = np.full(len(data), LAST, np.int32)
    rank[:-1] = held.byte_rank[data[:-1].astype(np.int64) << 8 | data[1:]]
    begin = np.cumsum(size) - size
    rank[begin + size - 1] = LAST
    while len(words):
        least = np.minimum.reduceat(rank, begin)
        over = least == LAST
        if over.any():
            of = np.repeat(over, size)
            counts[words[over]] = size[over]
            done.append((words[over], symbol[of]))
            symbol, rank = symbol[~of], rank[~of]
            words, size, least = words[~over], size[~over], least[~over]
            begin = np.cumsum(size) - size
            if not len(words):
                break
        at = np.flatnonzero(rank == np.repeat(least, size))
        at = at[np.searchsorted(at, begin)]
        symbol[at] = held.ids_made[least]
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        ends = begin + size - 1
        last = at + 1 == ends
        rank[at] = LAST
        inner = at[~last]
        rank[inner] = held.rank(symbol[inner] << 32 | symbol[inner + 2])
        after = at[at > begin]
        rank[after - 1] = held.rank(symbol[after - 1] << 32 | symbol[after])
        symbol, rank = symbol[stay], rank[stay]
        size = size - 1
        begin = np.cumsum(size) - size
    ids = np.zeros(counts.sum(), np.int64)
    begins = np.cumsum(counts) - counts
    for group, found in done:
        n = counts[group]
        ids[np.repeat(begins[group] - np.cumsum(n) + n, n) + np.arange(len(found))] = found
    return ids, counts


class Remembered(dict):
    """Word to its packed ids; the older half is dropped when the table is full."""

    def __init__(self, vocabulary: Vocabulary, kind: str):
        super().__init__()
        self.vocabulary, self.kind, self.older = vocabulary, kind, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            ids = self.vocabulary.merged(word.encode())
            found = np.array(ids, self.kind).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.cache
def _remembered(path: str, kind: str) -> Remembered:
    return Remembered(vocabulary(path), kind)


def pack(text: str, path: str = VOCABULARY, kind: str = "<u4", added: bool = True) -> bytes:
    """The ids of a text as packed little-endian integers.

    Without `added`, the strings of added tokens are ordinary text.
    """
    table = _remembered(path, kind)
    held = table.vocabulary
    find = table.__getitem__
    if not added or not held.added or not held.cut.search(text):
        return b"".join(map(find, words(text)))
    parts = []
    for i, part in enumerate(held.cut.split(text)):
        if i % 2:
            parts.append(np.array([held.added[part]], kind).tobytes())
        else:
            parts.extend(map(find, words(part)))
    return b"".join(parts)


def unpack(ids: bytes, path: str = VOCABULARY, kind: str = "<u4") -> str:
    """The text of packed ids: vocabulary strings end to end; bytes that are no UTF-8 are replaced."""
    strings = vocabulary(path).strings
    return b"".join(map(strings.__getitem__, np.frombuffer(ids, kind).tolist())).decode(
        "utf-8", "replace"
    )


def _offsets(column: pa.Array) -> np.ndarray:
    """Offsets of a large binary array."""
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def _bytes(column: pa.Array) -> memoryview:
    """All bytes of a large binary array's buffer."""
    return memoryview(column.buffers()[2] or b"")


def _packed_slice(
    data: np.ndarray, offsets: np.ndarray, path: str, kind: str, added: bool
) -> list[bytes]:
    """The packed ids of the texts `data[offsets[d]:offsets[d+1]]`."""
    whole = data.tobytes()
    n = len(offsets) - 1
    held = vocabulary(path)
    at = foreign(data)
    if added and held.added:
        at = np.append(at, [m.start() for m in held.cut_bytes.finditer(whole)]).astype(np.int64)
    by_pattern = np.zeros(n, bool)
    by_pattern[np.searchsorted(offsets, at, "right") - 1] = True
    out: list[bytes] = [b""] * n
    for d in np.flatnonzero(by_pattern).tolist():
        out[d] = pack(whole[offsets[d] : offsets[d + 1]].decode(), path, kind, added)
    sizes = np.diff(offsets)
    if by_pattern.any():
        data = data[np.repeat(~by_pattern, sizes)]
    rest = np.flatnonzero(~by_pattern & (sizes > 0))
    if not len(rest):
        return out
    begins = np.cumsum(sizes[rest]) - sizes[rest]
    first = np.zeros(len(data), bool)
    first[begins] = True
    cuts = np.append(np.flatnonzero(starts_of(data, first)), len(data))
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))]
    )
    numbered = found.dictionary_encode()
    spelt = np.frombuffer(_bytes(numbered.dictionary), np.uint8)
    distinct, counts = merged_together(held, spelt, _offsets(numbered.dictionary))
    places = np.append(0, np.cumsum(counts)) * np.dtype(kind).itemsize
    ids = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(places), pa.py_buffer(distinct.astype(kind))]
    ).take(numbered.indices)
    ends = _offsets(ids)[np.append(np.searchsorted(cuts, begins), len(cuts) - 1)].tolist()
    packed = _bytes(ids)
    for k, d in enumerate(rest.tolist()):
        out[d] = bytes(packed[ends[k] : ends[k + 1]])
    return out


def packed(
    column: pa.Array, path: str = VOCABULARY, kind: str = "<u4", added: bool = True
) -> pa.Array:
    """The packed ids of each text; null texts are empty."""
    data, offsets = W.buffers(column)
    out: list[bytes] = []
    for begin, end in W.slices(offsets, SLICE):
        low, high = offsets[begin], offsets[end]
        out += _packed_slice(data[low:high], offsets[begin : end + 1] - low, path, kind, added)
    return pa.array(out, pa.binary())


@functools.cache
def _strings(path: str) -> pa.Array:
    return pa.array(vocabulary(path).strings, pa.large_binary())


def unpacked(column: pa.Array, path: str = VOCABULARY, kind: str = "<u4") -> pa.Array:
    """The text of each row's packed ids, as `unpack` gives it; null ids are empty."""
    out: list[str] = []
    for value in column:
        ids = np.frombuffer(value.as_buffer() if value.is_valid else b"", kind)
        out.append(bytes(_bytes(_strings(path).take(pa.array(ids)))).decode("utf-8", "replace"))
    return pa.array(out, pa.string())


def encoded(
    text: Column, path: str = VOCABULARY, kind: str = "<u4", added: bool = True
) -> Column:
    """Packed ids of a text column as binary; `kind` is the numpy type of an id."""

    def over(column: pa.Array) -> pa.Array:
        return packed(column, path, kind, added)

    return F.arrow_udf(over, "binary")(text)


def decoded(ids: Column, path: str = VOCABULARY, kind: str = "<u4") -> Column:
    """Text of a column of packed ids."""

    def over(column: pa.Array) -> pa.Array:
        return unpacked(column, path, kind)

    return F.arrow_udf(over, "string")(ids)


def encode(
    docs: DataFrame, text: str = "text", into: str = "token_ids", path: str = VOCABULARY
) -> DataFrame:
    """Add the packed ids (unsigned 32-bit, little-endian) of a text column."""
    return docs.withColumn(into, encoded(F.col(f"`{text}`"), path))


def decode(
    docs: DataFrame, ids: str = "token_ids", into: str = "decoded", path: str = VOCABULARY
) -> DataFrame:
    """Add the text of a column of packed ids."""
    return docs.withColumn(into, decoded(F.col(f"`{ids}`"), path))


def digests(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Token count and digests of ids and decoded text per document."""
    both = decode(encode(docs.select("doc_id", "text"), path=path), path=path)
    return both.select(
        "doc_id",
        F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids and decoded text, as count and digests."""
    return digests(spark.read.parquet(f"{folder}/documents.parquet"))
