"""Decontamination against SQL on whole tables and against brute force on edge rows."""

import random
import re

import duckdb
import numpy as np

from kerbline.llm import op2_winnowing as op
from kerbline.llm import words as W

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return WORD.findall((text or "").translate(table))


def brute(text, items):
    words, hit, found = tokens(text), set(), set()
    for item, other in items:
        own = tokens(other)
        size = min(13, len(own))
        if not size:
            continue
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    bad = bool(hit) and 20 * len(hit) >= len(words)
    return len(words), len(hit), sorted(found), bad


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = op.query(spark, FOLDER)
    assert df.columns == con.sql(op.SQL).columns
    ours = sorted(tuple(r) for r in df.collect())
    assert ours == sorted(con.sql(op.SQL).fetchall())
    assert any(r[-1] for r in ours)


def test_edges_equal_brute_force(spark):
    pick = random.Random(3)
    vocabulary = ["Aa", "b", "é9", "cc", "dd1", "x"]
    say = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    items = [(1, say(40)), (2, say(13)), (3, say(7)), (4, "solo"), (5, ""), (6, None),
             (7, say(8)), (None, say(20)), (2, say(14))]
    texts = [None, "", "!!", "SOLO", say(3), say(12), items[1][1], items[0][1][5:] + " zz",
             "q " * 500 + items[2][1], say(3000), " ".join(t for _, t in items if t),
             "y " * 200 + "-".join(tokens(items[0][1])[3:17]) + " y" * 60, items[7][1].upper(),
             "w" * 3_000_000 + " " + items[1][1]]
    texts += [t for t in texts[5:8]]
    docs = spark.createDataFrame(
        [(i, t, "a") for i, t in enumerate(texts)] + [(0, None, None)],
        "doc_id long, text string, n_words string",
    )
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = op.scan(docs, bench).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == brute(texts[r.doc_id], items), r.doc_id
    kept = op.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    wanted = [i for i, t in enumerate(texts) if not brute(t, items)[-1]] + [0]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)
    assert op.scan(docs.filter("false"), bench).count() == 0
    assert op.scan(docs, bench.filter("false")).filter("contaminated").count() == 0


def test_winnowing_keeps_a_common_print():
    pick = np.random.default_rng(1)
    for _ in range(200):
        shared = pick.integers(0, 4, 6).astype(np.uint64)
        a = np.concatenate([pick.integers(0, 4, 9).astype(np.uint64), shared])
        b = np.concatenate([shared, pick.integers(0, 4, 5).astype(np.uint64)])
        at_a = {x - 9 for x in op.winnow(a, np.ones(len(a), bool)) if x >= 9}
        at_b = {x for x in op.winnow(b, np.ones(len(b), bool)) if x < 6}
        assert at_a & at_b


def test_words_and_hashes_equal_python():
    import pyarrow as pa

    texts = ["Hé llo  A", None, "", "a\tB\x0bc", "é" * 50, " x ", "one two", "b"]
    for kind, pattern in ((W.ALNUM, WORD), (W.SPACED, re.compile(r"[^\x20\x09-\x0D]+"))):
        seen = {}
        for begin, end, found in W.lowered(pa.array(texts), kind):
            hashes = found.hashes()
            for d in range(begin, end):
                own = range(found.first[d - begin], found.first[d - begin + 1])
                table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
                wanted = pattern.findall((texts[d] or "").translate(table))
                assert [found.text(i).decode() for i in own] == wanted
                for i in own:
                    assert seen.setdefault(found.text(i), hashes[i]) == hashes[i]
        assert len(set(map(int, seen.values()))) == len(seen)
