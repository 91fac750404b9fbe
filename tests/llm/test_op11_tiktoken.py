"""The tiktoken operator against a plain merge by rank over the pattern's matches, and the library itself."""

import hashlib
import random
import time

import public_tokenizers
import pyarrow as pa
import pytest
import regex

from kerbline.llm import op11_tiktoken as op

FOLDER = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  a", "a  b", "\n\n x\t\ty ", "it's we'll I'M", "a1b22 3c", "x.5 y,6", "don't.s 's1",
    "<|endoftext|>", "😀👍🏽 é é", "\xa0 x　　y ", "日本語のテキスト。123、456", "\x00\x01\x1c\x1d z",
    "ไทยภาษา हिन्दी भाषा", "__init__ foo_bar", " " * 9 + "x" + "\n" * 9,
]


def brute(text):
    """Merge the lowest rank, the leftmost first, in each match of the pattern."""
    ranks = op.encoding(op.RANKS)._mergeable_ranks
    out = []
    for match in regex.findall(public_tokenizers.PATTERN, text):
        parts = [bytes([b]) for b in match.encode()]
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        out += [ranks[p] for p in parts]
    return out


def test_odd_and_random_texts():
    pick = random.Random(5)
    alphabet = "aabceth' \n\t1²_,.<|é́日😀\x1c\xa0"
    for text in [*ODD, *("".join(pick.choice(alphabet) for _ in range(pick.randint(1, 60))) for _ in range(1500))]:
        assert op.ids_of(text) == brute(text), text
        assert op.encoding(op.RANKS).decode_bytes(op.ids_of(text)) == text.encode()


def test_cuts_change_nothing(monkeypatch):
    """Short parts and short runs, so that every kind of cut is taken, against the uncut text."""
    monkeypatch.setattr(op, "LONG_RUN", 3)
    monkeypatch.setattr(op, "_RUN", regex.compile(f"[{op.WHITE}]{{3,}}"))
    pick = random.Random(6)
    alphabet = "ab1 '  \n\t.,日。é　s\x1c²"
    for _ in range(3000):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randint(3, 80)))
        whole = op.encoding(op.RANKS).encode_ordinary(text)
        for part in (1, 2, 7):
            assert op.ids_of(text, part=part) == whole, (text, part)


@pytest.mark.parametrize("unit", ["a", " ", "\n", "ab^é", "日", "word ", "x1", "ไ", "\t \n"])
def test_very_long_texts(unit):
    text = "start" + unit * (1_500_000 // len(unit)) + "end "
    began = time.time()
    ids = op.ids_of(text)
    assert op.encoding(op.RANKS).decode_bytes(ids) == text.encode()
    assert time.time() - began < 60
    if unit in (" ", "\n"):  # one match but for the last character
        assert len(ids) < len(text)


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = op.query(spark, FOLDER).collect()
    assert len(found) == len(docs)
    for row in found:
        ids = brute(docs[row.doc_id]) if len(docs[row.doc_id]) < 5_000 else op.encoding(op.RANKS).encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_edges(spark):
    rows = [(1, None, "x", 1), (2, "", None, 2), (2, "", None, 2), (None, "ab", "y", 3), (4, "é" * 300_000, "z", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, `a.b` int")
    found = op.decode(op.encode(docs, into="own"), ids="own", into="bytes")
    assert found.columns == ["doc_id", "text", "token_ids", "a.b", "own", "bytes"]
    assert sorted((bytes(r["bytes"]).decode(), r.token_ids or "", r["a.b"]) for r in found.collect()) == [
        ("", "", 2), ("", "", 2), ("", "x", 1), ("ab", "y", 3), ("é" * 300_000, "z", 4),
    ]
    replaced = op.encode(docs)
    assert replaced.columns == docs.columns and replaced.schema["token_ids"].dataType.simpleString() == "array<int>"
    assert op.digests(docs).count() == 5
    assert op.digests(docs.filter("false")).count() == 0
    part = spark.createDataFrame([([op.ids_of("é")[0]],), (None,), ([],)], "token_ids array<int>")
    assert sorted(bytes(r.decoded) for r in op.decode(part).collect()) == [b"", b"", "é".encode()]
    byte = op.encoding(op.RANKS)._mergeable_ranks[b"\xc3"]
    assert bytes(op.decode(spark.createDataFrame([([byte],)], "token_ids array<int>")).first().decoded) == b"\xc3"


def test_columns_are_read_and_made_as_arrays():
    texts = ["a b", "", " " * 5000 + "é日本", "it's 12", *ODD]
    made = op._lists(op._ids(t, op.RANKS) for t in texts)
    assert made.type == pa.list_(pa.int32())
    assert made.to_pylist() == [op.ids_of(t) for t in texts]
    assert op.bytes_of(made).to_pylist() == [t.encode() for t in texts]
    gaps = pa.array([[5], None, [], op.ids_of("é"), None, op.ids_of("x y")], pa.list_(pa.int32()))
    assert op.bytes_of(gaps.slice(1)).to_pylist() == [b"", b"", "é".encode(), b"", b"x y"]
    assert len(op._lists(iter([]))) == len(op.bytes_of(gaps.slice(6))) == 0
