"""Divergence of sources against SQL and plain dictionaries; trees, bands, blocks and edges."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from kerbline.llm import op12_divergence as op

FOLDER = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, lang string, source string"


def brute(rows, least=10, top=10):
    docs = [tuple(v or "" for v in r) for r in rows]
    counts, seen, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        terms = TERM.findall(lower)
        sources[lang].add(source)
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, own in sources.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        held = {s: {t: counts[lang, s][t] for t in kept} for s in own}
        whole = {t: sum(h[t] for h in held.values()) for t in kept}

        def shares(found):
            return {t: 1 + 10**9 * (found[t] + 2) // (sum(found.values()) + 2 * len(kept)) for t in kept}

        p, q = {s: shares(h) for s, h in held.items()}, shares(whole)

        def price(a, b, t):
            return (a[t] - b[t]) ** 2 // (a[t] + b[t])

        for s in own:
            pairs = [(-sum(price(p[s], p[o], t) for t in kept), o) for o in own if o != s]
            terms = [(-price(p[s], q, t), t) for t in kept if held[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda r: (r[0], r[1].encode()))[:most]
                out += [(lang, s, part, i, -v, n) for n, (v, i) in enumerate(ranked, 1)]
    return sorted(out)


def found(df, **given):
    return sorted(tuple(r) for r in op.audit(df, **given).collect())


def made(seed, sources=6, docs=300):
    pick = random.Random(seed)
    words = [f"{a}{b}" for a in ("Haus", "été", "x", "ИЯ", "it's") for b in ("", "a", "Q", "1b", "ß")]
    return [
        (" ".join(pick.choice(words[: 5 + k % 20]) for _ in range(k % 40)), pick.choice(["en", "de", None]), f"s{k % sources}")
        for k in range(docs)
    ]


def test_equals_brute_force(spark):
    rows = made(1)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)
    assert found(spark.createDataFrame(rows, SCHEMA), least_docs=40, top=2) == brute(rows, 40, 2)


@pytest.mark.parametrize("leaves", [1, 4])
def test_bands_and_small_blocks(spark, monkeypatch, leaves):
    """More sources than a band holds, and few terms in a block."""
    monkeypatch.setattr(op, "BAND", 3)
    monkeypatch.setattr(op, "LEAVES", leaves)
    rows = made(2, sources=11, docs=500)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_trees_share_nodes(monkeypatch):
    counts = np.zeros((3, 64), np.int64)
    counts[1, :3] = (5, 1, 1)
    counts[2] = 1
    forest = op.Forest(counts)
    nodes = sum(len(left) for left, _ in forest.children)
    assert nodes < 20  # 189 without sharing
    of, x, y, times = forest.leaf_pairs(np.array([0, 0, 1]), np.array([1, 2, 2]))
    met = list(zip(of.tolist(), forest.values[x].tolist(), forest.values[y].tolist(), times.tolist(), strict=True))
    assert met == [(0, 0, 0, 61), (0, 0, 1, 2), (0, 0, 5, 1), (1, 0, 1, 64), (2, 0, 1, 61), (2, 1, 1, 2), (2, 5, 1, 1)]
    monkeypatch.setattr(op, "PAIRS", 64)
    totals = np.array([200, 300, 400])
    for a, b in ((0, 1), (1, 2)):
        wanted = 0
        for m, n in zip(counts[a].tolist(), counts[b].tolist(), strict=True):
            p, q = (1 + 10**9 * (c + 2) // int(totals[t]) for c, t in ((m, a), (n, b)))
            wanted += (p - q) ** 2 // (p + q)
        assert op._pair_prices(forest, totals, np.array([a, a]), np.array([b, b])).tolist() == [wanted] * 2


def test_shares_of_very_large_counts():
    n = np.array([0, 7, 9 * 10**12, 5 * 10**14])
    total = np.array([10**13, 9, 10**13, 5 * 10**14 + 11])
    wanted = [1 + 10**9 * (a + 2) // b for a, b in zip(n.tolist(), total.tolist(), strict=True)]
    assert op.shares(n, total).tolist() == wanted


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    wanted = con.execute(f"SELECT * FROM ({op.SQL}) ORDER BY ALL").fetchall()
    df = op.query(spark, FOLDER)
    assert df.dtypes == [
        ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int"),
    ]
    assert sorted(tuple(r) for r in df.collect()) == sorted(wanted) and wanted


def test_edges(spark):
    long = "wort " * 400_000 + "A" * 100_000
    rows = [(None, None, None), ("", "", "a"), ("", "en", "a"), ("123 --", "en", "b"), (long, "de", "x"), (long, "de", "y")]
    rows += [("wort Satz", "de", "x")] * 12 + [("SATZ", "de", None), ("satz wort", "fr", "only")] + [("é É z", "fr", "only")] * 10
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert ("en", "a", "pair", "b", 0, 1) in brute(rows)
    extra = spark.createDataFrame(
        [(*r, 7, "u", 1) for r in rows[4:]], f"{SCHEMA}, n int, term string, `a.b` int"
    )
    assert found(extra) == brute(rows[4:])
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, None, None)], SCHEMA)) == []


def test_counts_of_a_task_are_passed_on_in_small_batches(spark, monkeypatch):
    """Counts of many groups and terms come whole, and no batch that a task hands on is large."""
    rows = [(i, f"a{chr(97 + i % 26)} b{'c' * (i % 40)} a{chr(97 + i % 26)}", "en" if i % 3 else "de", f"s{i % 7}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(2)
    monkeypatch.setattr(op, "ROWS", 16)
    monkeypatch.setattr(op, "BYTES", 1_000)
    sizes = []
    monkeypatch.setattr(type(docs), "mapInArrow", _handed_on(type(docs).mapInArrow, sizes))
    found = {(r["lang"], r["source"], r.term): (r["n"], r["docs"]) for r in op.count_terms(docs).collect()}
    wanted = {}
    for _, text, lang, source in rows:
        for term in set(text.split()):
            n, times = wanted.get((lang, source, term), (0, 0))
            wanted[lang, source, term] = n + text.split().count(term), times + 1
    assert found == wanted
    assert max(r[0] for r in sizes[0].collect()) <= 16


def _handed_on(original, sizes):
    """mapInArrow that also keeps a plan of the sizes of the batches."""

    def mapped(self, function, schema):
        def measured(batches):
            for batch in function(batches):
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["rows"])

        sizes.append(original(self, measured, "rows long"))
        return original(self, function, schema)

    return mapped


def test_batches_of_the_session_stay_as_they_were(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "a b", "en", "x")], "doc_id long, text string, lang string, source string")
    assert sorted(tuple(r) for r in op._counted(docs).collect()) == [("en", "x", "a", 1, 1), ("en", "x", "b", 1, 1)]
    assert spark.conf.get(name) == before
