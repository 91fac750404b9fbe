"""BPE against the tokenizers library: all documents of the small tables, odd and random texts."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kerbline.llm import op8_bpe as bpe

FOLDER = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  a", "a  b", "\n\n x\t\ty ", "it's we'll I'M", "²³ Ⅷ ½x", "a\x1cb \x1f c", "՘x ࢏",
    "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>c", "😀👍🏽 é é", "  x",
    "__init__ foo_bar", "日本語のテキスト 123,456.78", "\x00\x01", "Ᲊ new letter",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


def same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    packed = bpe.pack(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids, text[:80]
    assert bpe.unpack(packed) == library.decode(ids, skip_special_tokens=False)


def test_odd_and_random_texts(library):
    for text in ODD:
        same(library, text)
    pick = random.Random(7)
    alphabet = "aabceth' \n\t1²_,.<|é́日😀\x1c"
    for _ in range(2000):
        same(library, "".join(pick.choice(alphabet) for _ in range(pick.randint(1, 60))))


def test_single_code_points(library):
    for code in range(0, 0x30000, 7):
        if not 0xD800 <= code < 0xE000:
            same(library, f"a{chr(code)}1 {chr(code)}")


def test_long_text_without_spaces(library):
    text = "".join(random.Random(1).choice("abcdeé") for _ in range(300_000))
    began = time.time()
    same(library, text[:50_000])
    assert bpe.unpack(bpe.pack(text)) == text
    assert time.time() - began < 60


def test_ids_that_are_no_text():
    assert bpe.unpack(np.array([bpe.vocabulary(bpe.VOCABULARY).byte[0xE9]], "<u4").tobytes()) == "�"


def test_query_equals_library(spark, library):
    docs = {
        r.doc_id: r.text or ""
        for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    }
    found = bpe.query(spark, FOLDER).collect()
    assert len(found) == len(docs)
    for row in found:
        ids = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", None), (2, "", None), (None, "ab", "y")],
        "doc_id long, text string, token_ids string",
    )
    found = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((r.decoded, len(r.token_ids)) for r in found) == [("", 0), ("", 0), ("", 0), ("ab", 4)]
    assert bpe.digests(docs).count() == 4
    assert bpe.digests(docs.filter("false")).count() == 0


def test_short_words_merge_as_with_the_queue(monkeypatch):
    held, drawn = bpe.vocabulary(bpe.VOCABULARY), random.Random(3)
    words = [bytes(drawn.choice(b"aaabtheringso \xc3\xa9") for _ in range(n)) for n in range(1, 41) for _ in range(40)]
    assert len(held._merged_short([held.byte[b] for b in b" the"])) == 1
    short = [held.merged(w) for w in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert [held.merged(w) for w in words] == short


def test_columns_equal_the_library(library):
    """Cut by classes of bytes or by the pattern, text beside text, each row is as the library has it."""
    pick = random.Random(11)
    kinds = [
        "aabces' \n\t1_,.<|", "dlmrstve''' x\n", "éßñłaz' \x1c9\n", "é×÷²ab'  ", "ab\x85 \xa0's", "日本 a's", "a<|endoftext|> s'll",
    ]
    texts = [None, *ODD, "it's", "'ll", "'", "s", "<|endoftext|", ">", *(
        "".join(pick.choice(pick.choice(kinds)) for _ in range(pick.randint(0, 40))) for _ in range(2000)
    )]
    texts += ["".join(pick.choice(kind) for _ in range(pick.randint(0, 40))) for kind in kinds for _ in range(1000)]
    texts += ["'s<|endoftext|>it's  <|endoftext|>", " \n 'rex 'll\t've''d"]
    column = pa.array([None, "never seen", *texts]).slice(2)
    ids = bpe.packed(column)
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(i, "<u4").tolist() for i in ids.to_pylist()] == wanted
    assert bpe.unpacked(ids).to_pylist() == [library.decode(i, skip_special_tokens=False) for i in wanted]
    assert len(bpe.packed(pa.array([], pa.string()))) == 0
    plain = bpe.packed(column, added=False).to_pylist()
    assert plain == [bpe.pack(t or "", added=False) for t in texts]


def test_a_column_merges_each_distinct_word_once(monkeypatch):
    seen, whole = [], bpe.merged_together
    monkeypatch.setattr(bpe, "merged_together", lambda held, data, cuts: seen.append(len(cuts) - 1) or whole(held, data, cuts))
    monkeypatch.setattr(bpe.Vocabulary, "merged", lambda *_: pytest.fail("one by one"))
    assert len(bpe.packed(pa.array(["été this that this", "that été this"] * 500))) == 1000
    assert seen == [5]


def test_words_merge_side_by_side_as_one_by_one():
    held, drawn = bpe.vocabulary(bpe.VOCABULARY), random.Random(4)
    words = [bytes(drawn.choice(b"aaabtheringso \xc3\xa9") for _ in range(n)) for n in range(0, 60) for _ in range(30)]
    cuts = np.append(0, np.cumsum([len(w) for w in words]))
    ids, counts = bpe.merged_together(held, np.frombuffer(b"".join(words), np.uint8), cuts)
    wanted = [held.merged(w) if w else [] for w in words]
    assert counts.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]
    none = bpe.merged_together(held, np.zeros(0, np.uint8), np.zeros(1, np.int64))
    assert [len(x) for x in none] == [0, 0]
