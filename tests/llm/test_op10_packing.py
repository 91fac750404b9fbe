"""Packing: exact round trip, best fit against a plain search, edges."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from kerbline.llm import op10_packing as op
from kerbline.llm.op8_bpe import pack

FOLDER = "/root/testdata/sf0.001"


def plain_best_fit(sizes, length):
    rooms, rows = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(room, k) for k, room in enumerate(rooms) if room >= sizes[i]]
        if fits:
            k = min(fits)[1]
        else:
            k = len(rows)
            rooms.append(length), rows.append([])
        rooms[k] -= sizes[i]
        rows[k].append(i)
    return rows, rooms


def test_best_fit_equals_plain_search():
    pick = np.random.default_rng(2)
    for length in (1, 2, 7, 16, 100):
        for n in (0, 1, 5, 200):
            sizes = pick.integers(1, length + 1, n)
            rows = op.best_fit(sizes, length)
            assert sorted(i for r in rows for i in r) == list(range(n))
            used = sorted(int(sizes[r].sum()) for r in rows)
            _, rooms = plain_best_fit(sizes.tolist(), length)
            assert used == sorted(length - room for room in rooms)


def restored(packed, kind=op.KIND):
    parts = defaultdict(dict)
    for r in op.unpack(packed, kind).collect():
        parts[r.doc_id][r.doc_offset] = bytes(r.ids)
    return {d: b"".join(p[k] for k in sorted(p)) for d, p in parts.items()}


def test_query_round_trip(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    packed = op.query(spark, FOLDER)
    found = restored(packed)
    assert set(found) == set(docs)
    for d, data in found.items():
        ids = np.frombuffer(data, op.KIND)
        # the ids of the BPE operator with an end id
        assert ids[-1] == op.END and ids[:-1].tobytes() == pack(docs[d], kind=op.KIND, added=False)
    rows = packed.collect()
    assert all(len(r.input_ids) == 2 * op.LENGTH for r in rows)
    assert len({r.pack_id for r in rows}) == len(rows)
    for r in rows:
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= op.LENGTH
        assert r.position_resets == r.cu_seqlens[:-1]
        assert (np.frombuffer(r.input_ids, op.KIND)[r.n_tokens :] == op.PAD).all()
    assert sum(r.n_tokens for r in rows) > 0.9 * op.LENGTH * (len(rows) - 8)


def test_edges(spark):
    long = np.arange(1, 1001).astype("<u4").tobytes()
    rows = [(1, None, "a"), (2, b"", None), (3, long, "b"), (4, long[:40], "c"), (4, long[:40], "c"), (None, long[:8], None)]
    docs = spark.createDataFrame(rows, "doc_id long, x binary, ids string")
    packed = op.pack(docs, F.col("x"), length=64, kind="<u4", group=500)
    found = op.unpack(packed, "<u4").groupBy("doc_id").agg(F.sum(F.length("ids"))).collect()
    assert {tuple(r) for r in found} == {(3, 4000), (4, 80), (None, 8)}
    assert restored(packed, "<u4")[3] == long
    placed = op.positions(packed, 64).collect()
    for r in placed:
        assert len(r.position_ids) == 64
        assert [i for i in range(r.n_tokens) if r.position_ids[i] == 0] == r.position_resets
    assert op.pack(docs.filter("false"), F.col("x")).count() == 0


def test_written_files(spark, tmp_path):
    docs = spark.createDataFrame([(1, "ab"), (2, "")], "doc_id int, text string")
    op.write(op.pack(docs, F.col("text"), tokenise=op.bpe_ids), str(tmp_path / "p"))
    end = np.array([op.END], "<u2").tobytes()
    assert restored(spark.read.parquet(str(tmp_path / "p"))) == {
        1: pack("ab", kind="<u2") + end, 2: end
    }
