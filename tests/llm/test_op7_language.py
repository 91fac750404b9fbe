"""Language identification: sums over segmentations by brute force, held-out accuracy, edges."""

import math
import random
import time
import zlib

import numpy as np

from kerbline.llm import op7_language as op

FOLDER = "/root/testdata/sf0.01"


def piece_at(held, text):
    below, piece = held.root, -1
    for c in text:
        piece, below = below.get(c, (-1, {}))
    return piece


def brute(held, text, p):
    """Sum over all segmentations by recursion."""
    if not text:
        return 1.0
    total = 0.0
    for j in range(1, len(text) + 1):
        piece = piece_at(held, text[:j])
        if piece >= 0:
            total += p[piece] * brute(held, text[j:], p)
    if piece_at(held, text[:1]) < 0:
        total += p[held.byte[text[0].encode()[0]]] * brute(held, text[1:], p)
    return total


def test_forward_equals_all_segmentations():
    held = op.pieces(op.PIECES)
    table = np.random.default_rng(1).dirichlet(np.full(held.size, 0.5), 2).T
    words = ["the", "a", "étrange", "日本語", "ꙮx", "tionthe"]
    logs = op.log_probabilities(held, words, table)
    for k, word in enumerate(words):
        for lang in range(2):
            wanted = math.log(brute(held, op.BEGIN + word, table[:, lang]))
            assert abs(logs[k, lang] - wanted) < 1e-9
    long = "abcdefghij" * 10
    sums, scale = op._long(held, long[:25], table)
    short = op.log_probabilities(held, [long[:25]], table)[0]
    assert np.allclose(np.log(sums[-1]) + scale[-1], short)
    assert np.isfinite(op.log_probabilities(held, [long, ""], table)).all()


def test_query_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = op.query(spark, FOLDER).collect()
    assert len(found) == len(truth)
    right = []
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.held_out and truth[r.doc_id].lang:
            right.append(r.lang_pred == truth[r.doc_id].lang)
    assert len(right) > 200
    assert sum(right) / len(right) > 0.95


def test_edges(spark):
    rows = [(1, None, "en", "x"), (2, "", "en", None), (3, "12 ²³ !", None, "y"), (4, "hello there world", "en", "z"),
            (5, "bonjour le monde", "fr", "z"), (5, "bonjour le monde", "fr", "z"), (None, "le monde", None, None),
            (7, "a" * 100_000, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = op.train(docs)
    assert model.languages == ["en", "fr"]
    found = sorted((str(r.doc_id), r.lang_pred) for r in op.predict(docs, model).collect())
    assert found == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "en"), ("5", "fr"), ("5", "fr"),
                     ("7", "en"), ("None", "fr")]
    empty = op.train(docs.filter("false"))
    assert {r.lang_pred for r in op.predict(docs, empty).collect()} == {"und"}
    assert op.predict(docs.filter("false"), model).count() == 0


def test_marks_belong_to_words():
    assert op.letters().findall("हिन्दी भाषा, ภาษาไทย e\u0301te\u0301 a1b \u0301x") == [
        "हिन्दी", "भाषा", "ภาษาไทย", "e\u0301te\u0301", "a", "b", "x",
    ]
    assert op.spelled("हिन्दी") == "हिन्दी" and op.spelled("²\u0301") == "" and op.spelled("x²") == "x"
    began = time.time()
    op.letters().findall("a\u0301" * 500_000 + "1" + "b" * 1_000_000)
    assert time.time() - began < 5


def test_scripts_with_marks_are_told_apart(spark):
    hindi = "यह हिन्दी में लिखा हुआ एक छोटा पाठ है और इसमें कुछ शब्द हैं"
    marathi = "हा मराठीत लिहिलेला एक छोटा मजकूर आहे आणि त्यात काही शब्द आहेत"
    thai = "นี่คือข้อความภาษาไทยสั้น ๆ ที่มีคำอยู่บ้าง"
    docs = spark.createDataFrame([(1, hindi, "hi"), (2, marathi, "mr"), (3, thai, "th")] * 3, "doc_id long, text string, lang string")
    model = op.train(docs)
    asked = spark.createDataFrame([(1, "हिन्दी में कुछ शब्द"), (2, "मराठीत काही शब्द आहेत"), (3, "ภาษาไทยสั้น"), (4, "\u0301\u0902")], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in op.predict(asked, model).collect()}
    assert found == {1: "hi", 2: "mr", 3: "th", 4: "und"}


def test_plain_words_equal_those_of_all_marks():
    drawn = random.Random(5)
    kinds = [range(32, 127), range(32, 0x300), range(32, 0x1200), [0x130, 0x2FF, 0x300, 0x20, 0x41, 0x903]]
    for kind in kinds:
        text = "".join(chr(drawn.choice(kind)) for _ in range(4_000))
        assert op.words_of(text) == op.letters().findall(text.lower())


def walked(held, words):
    """All arcs, letter by letter down the tree."""
    out = []
    for w, word in enumerate(words):
        text = op.BEGIN + word
        for i, c in enumerate(text):
            piece, below = held.root.get(c, (-1, {}))
            out.append((w, i, i + 1, piece if piece >= 0 else held.byte[c.encode()[0]]))
            for j in range(i + 1, len(text)):
                if text[j] not in below:
                    break
                piece, below = below[text[j]]
                if piece >= 0:
                    out.append((w, i, j + 1, piece))
    return out


def test_arcs_of_all_words_at_once(monkeypatch):
    held, drawn = op.pieces(op.PIECES), random.Random(6)
    words = ["", "the", "a", "\u0130\U00010400", "the" * 200, "日本語のテキスト", "straßenbahnhaltestelle"]
    words += ["".join(drawn.choice("etaonishréüб日ꙮ\U0001f600") for _ in range(drawn.randint(1, 12))) for _ in range(500)]
    wanted = walked(held, words)
    monkeypatch.setattr(held, "root", None)  # the tree of dicts is not walked
    assert list(zip(*(x.tolist() for x in held.arcs(words)), strict=True)) == wanted
    assert [len(x) for x in held.arcs([])] == [0] * 4
