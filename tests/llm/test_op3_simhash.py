"""SimHash groups against brute force over all pairs."""

import random
import re
from itertools import combinations

import xxhash

from kerbline.llm import op3_simhash as op

FOLDER = "/root/testdata/sf0.001"


def brute_print(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + size]).encode(), seed=42).intdigest()
        for i in range(len(words) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(prints))]


def test_masks_cover_every_pair_of_bits():
    assert max((64 - (m | n).bit_count()) for m, ns in zip(op.FIRST, op.SECOND, strict=True) for n in ns) <= 12
    for a, b in combinations(range(64), 2):
        both = 1 << a | 1 << b
        first = [k for k, m in enumerate(op.FIRST) if not m & both]
        assert first
        assert all(any(not n & both for n in op.SECOND[k]) for k in first)


def test_query_equals_brute_force(spark):
    docs = sorted(
        (r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    )
    prints = [brute_print(t) for _, t in docs]
    groups = brute_groups(prints)
    wanted = {d: (f"{p:016x}", docs[g][0]) for (d, _), p, g in zip(docs, prints, groups, strict=True)}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in op.query(spark, FOLDER).collect()}
    assert found == wanted
    assert len(set(groups)) < len(docs)


def test_crowded_buckets(spark):
    pick = random.Random(5)
    centre = pick.getrandbits(64)
    prints = {centre}
    while len(prints) < 900:  # a large group of near copies: many fingerprints near one
        prints.add(centre ^ 1 << pick.randrange(64) ^ 1 << pick.randrange(64) ^ 1 << pick.randrange(24))
    prints = sorted(prints | {pick.getrandbits(64) for _ in range(300)})
    rows = [(i, op._signed(p)) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, f"doc_id long, {op.FP} long")
    found = {r.doc_id: r._root for r in op.grouped(df).collect()}
    groups = brute_groups(prints)
    ours = {}
    for i, g in enumerate(groups):
        assert ours.setdefault(found[i], g) == g
    assert len(ours) == len(set(groups))


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "One"), (5, "one"), (6, "one two"), (7, long),
            (8, long), (9, "é É"), (7, long), (None, "solo word here now"), (None, None)]
    docs = spark.createDataFrame(
        [(*r, "c", i) for i, r in enumerate(rows)], "doc_id long, text string, component_id string, _root int"
    ).drop("_root")
    found = op.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id in (1, 2, 3):
            assert (r.fingerprint, r.component_id) == ("0" * 16, 1)
        if r.doc_id in (7, 8):
            assert r.component_id == 7
        if r.doc_id in (4, 5):
            assert r.component_id == 4
    kept = op.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) and sorted(
        (r.doc_id is None, r.doc_id or 0) for r in kept.collect()
    ) == [(False, 1), (False, 4), (False, 6), (False, 7), (False, 9), (True, 0)]
    assert op.near_duplicates(docs.filter("false")).count() == 0
    assert op.deduplicate(docs.filter("false")).count() == 0
