"""Byte-level BPE with the tiktoken library and a local rank file; decoding gives raw bytes.

The library cuts a text by the published pattern and merges each match by rank. A text goes to it in
parts of about PART characters, so its memory does not grow with the text. Parts are cut only where every
match ends: before white space that follows another character, or between a letter and a digit or one of a
few marks (no alternative of the pattern goes across these, none looks behind, and the one that looks
ahead sees white space only). A text without such a place stays one part. The library's pattern engine runs
out of stack on very long runs of white space, so these are merged as the single match that they are: a
whole run at the end of a text, otherwise all of it but its last character, which may start the next match.

Null texts count as empty; empty texts have no ids and decode to no bytes. Rows repeat as given. All columns
pass through, whatever their names; a column that has the name asked for the result is replaced. A null
column of ids decodes to no bytes. An id outside the rank file is an error.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = "op11_tiktoken"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Characters after which the next safe place ends a part.
PART = 200_000
#: Runs of white space of at least this length are merged by themselves.
LONG_RUN = 4_096
#: Ids of one Arrow array, whose offsets are 32 bits wide.
IDS = 2**30

# White space of the pattern, as Unicode defines it.
WHITE = "\t-\r \x85\xa0  -     　"
#: Letters in every version of Unicode: Latin, Greek, Cyrillic, kana, ideographs, Hangul.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ſα-ωА-яぁ-ゔァ-ヺ一-龥가-힣"

_RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")
_SAFE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=[{LETTERS}])(?=[0-9.,;:!?()、。])|(?<=[0-9])(?=[{LETTERS}])")


@functools.cache
def encoding(path: str) -> tiktoken.Encoding:
    """The library's encoding for a file of ranks (base64 of a token, its rank)."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _parts(text: str, part: int) -> Iterator[str]:
    """The text cut at safe places, each at least `part` characters after the one before."""
    begin = 0
    while len(text) - begin > part:
        found = _SAFE.search(text, begin + part)
        if not found:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


def ids_of(text: str, path: str = RANKS, part: int = PART) -> list[int]:
    """The ids of a text."""
    return _ids(text, path, part).tolist()


def _ids(text: str, path: str, part: int = PART) -> np.ndarray:
    held = encoding(path)
    if len(text) < LONG_RUN:
        return _ordinary(held, text)
    out: list[np.ndarray] = []
    begin = 0
    for run in _RUN.finditer(text):
        out += [_ordinary(held, piece) for piece in _parts(text[begin : run.start()], part)]
        begin = run.end() - (run.end() < len(text))
        out.append(np.array(held._encode_single_piece(text[run.start() : begin].encode()), np.uint32))
    out += [_ordinary(held, piece) for piece in _parts(text[begin:], part)]
    return np.concatenate(out)


def _ordinary(held: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a text without special tokens; as an array they take 4 bytes each."""
    return held.encode_to_numpy(text, disallowed_special=())


def encoded(text: Column, path: str = RANKS) -> Column:
    """The ids of a text column, as an array of integers."""

    def over(column: pa.Array) -> pa.Array:
        return _lists(_ids(t or "", path) for t in column.to_pylist())

    return F.arrow_udf(over, "array<int>")(text)


def _lists(rows: Iterator[np.ndarray]) -> pa.Array:
    """Arrays as the rows of a list array."""
    held, ends = [np.zeros(0, np.uint32)], [0]
    for row in rows:
        held.append(row)
        ends.append(ends[-1] + len(row))
    if ends[-1] > IDS:
        raise ValueError(f"a batch has more than {IDS} ids: lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held).view(np.int32)))


def bytes_of(column: pa.Array, path: str = RANKS) -> pa.Array:
    """The bytes of each list of ids; a null list has none. A batch's ids are read from its one array."""
    held = encoding(path)
    ids, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    valid = column.is_valid().to_pylist()
    out = [
        held.decode_bytes(ids[begin:end].tolist()) if given else b""
        for given, begin, end in zip(valid, offsets[:-1], offsets[1:], strict=True)
    ]
    return pa.array(out, pa.binary())


def decoded(ids: Column, path: str = RANKS) -> Column:
    """The bytes of a column of ids. They need not be UTF-8: a token may hold part of a character."""

    def over(column: pa.Array) -> pa.Array:
        return bytes_of(column, path)

    return F.arrow_udf(over, "binary")(ids)


def encode(docs: DataFrame, text: str = "text", into: str = "token_ids", path: str = RANKS) -> DataFrame:
    """Add the ids of a text column."""
    return docs.withColumn(into, encoded(F.col(f"`{text}`"), path))


def decode(docs: DataFrame, ids: str = "token_ids", into: str = "decoded", path: str = RANKS) -> DataFrame:
    """Add the bytes of a column of ids."""
    return docs.withColumn(into, decoded(F.col(f"`{ids}`"), path))


def digests(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """Number of tokens, and digests of the ids and of the decoded bytes, per document."""
    both = decode(encode(docs.select("doc_id", "text"), path=path), path=path)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids and decoded bytes, as count and digests."""
    return digests(spark.read.parquet(f"{folder}/documents.parquet"))
