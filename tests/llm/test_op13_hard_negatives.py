"""Hard negatives against all scores by brute force, and the bounds of the scan."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbline.llm import op13_hard_negatives as op

SCHEMA = "vec_id long, label long, codes array<long>"


def brute(rows, every, positives=5, negatives=5, percent=80):
    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    rows = [r for r in rows if None not in r and None not in r[2]]
    out = []
    for i, label, codes in rows:
        if i % every:
            continue
        scored = sorted((-score(codes, c), j, own) for j, own, c in rows if j != i)
        best = [(j, -s) for s, j, own in scored if own == label][:positives]
        for j, top in best:
            inside = [(k, -s) for s, k, own in scored if own != label and percent * top <= -100 * s <= 100 * top]
            out += [(i, j, n, k, top, s) for n, (k, s) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def found(spark, rows, every, **given):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in op.mine(df, F.expr(f"vec_id % {every} = 0"), **given).collect())


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, monkeypatch, seed):
    """Small blocks, few dimensions between looks, many ties, close labels, one chunk or several."""
    monkeypatch.setattr(op, "CHUNK", (8_000_000, 700)[seed % 2])
    made = np.random.default_rng(seed)
    wide = (3, 12, 30, 1)[seed]
    centre = made.integers(-40, 90, wide)
    rows = [(i, int(made.integers(0, 3)), (centre + made.integers(-9, 10, wide)).tolist()) for i in range(400)]
    rows += [(400 + i, 1, rows[5][2]) for i in range(60)]  # copies of one vector
    small = {"block_rows": 40, "step": 1 + seed}
    assert found(spark, rows, 20, **small) == brute(rows, 20)
    assert found(spark, rows, 50, positives=2, negatives=7, least_percent=95, **small) == brute(rows, 50, 2, 7, 95)


def test_scan_drops_rows_early():
    """Rows far away leave the bitmap before their dimensions are all read."""
    made = np.random.default_rng(1)
    codes = made.integers(-20, 20, (2000, 64))
    codes[:10] = 200
    table = pa.table({"vec_id": np.arange(2000), "label": np.zeros(2000, np.int64), "codes": codes.tolist()})
    block = op.Block(table, op.Anchors(np.array([0]), np.array([0]), codes[:1]))
    reads = []

    class Column:
        def __init__(self, values):
            self.values = values

        def __getitem__(self, at):
            got = self.values[at]
            reads.append(len(got))
            return got

    class Columns(list):
        dtype = block.columns.dtype

    block.columns = Columns(map(Column, block.columns))
    at, scores = block.scan(codes[0], 0, 2000, False, op.NONE, 2**62, 2**62, 5)
    assert sorted(block.ids[at]) == list(range(10)) and (scores == 64 * 200 * 200).all()
    assert len(reads) == 64 and reads[: op.STEP] == [2000] * op.STEP and sum(r < 50 for r in reads) >= 16


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    names = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    wanted = con.execute(f"SELECT {names} FROM ({op.SQL}) ORDER BY ALL").fetchall()
    df = op.query(spark, folder)
    assert df.dtypes == [(n, "int" if n == "rank" else "bigint") for n in names.split(", ")]
    assert sorted(tuple(r) for r in df.collect()) == wanted and wanted


def test_edges(spark):
    rows = [
        (None, 1, [1, 2]), (0, None, [1, 2]), (100, 1, None), (200, 1, [1, None]), (300, 1, [4, 4]), (1, 1, [3, 3]),
        (2, 2, [3, 3]), (2, 2, [3, 3]), (4, 2, [3]), (5, 2, [1, 2, 9]), (6, 3, []), (400, 7, [1, 1]), (300, 1, [4, 4]),
        (500, 1, [-4, -4]), (600, 4, [0, 0]), (7, 4, []), (8, 5, [0, 0]),
    ]
    assert found(spark, rows, 100) == brute(rows, 100)
    assert found(spark, [], 100) == []
    assert found(spark, [(1, 1, [1])], 100) == []
    extra = spark.createDataFrame([(100, 1, [2], "x", 1), (1, 1, [2], "y", 2), (2, 2, [2], "z", 3)], f"{SCHEMA}, `of` string, `a.b` int")
    assert [tuple(r) for r in op.mine(extra, F.expr("vec_id = 100")).collect()] == [(100, 1, 1, 2, 4, 4)]


def test_codes(spark):
    rows = [([0.5, -0.001],), ([float("nan")],), ([float("-inf"), 1.0],), ([None],), (None,), ([],)]
    made = spark.createDataFrame(rows, "embedding array<float>").select(op.coded(F.col("embedding")).alias("c"))
    assert [r.c for r in made.collect()] == [[128, -1], None, None, None, None, []]


def test_large_codes(spark):
    rows = [(100, 1, [2**27, 3]), (1, 1, [2**26, 5]), (2, 2, [2**26, 4])]
    assert found(spark, rows, 100) == brute(rows, 100)
    with pytest.raises(Exception, match="may not fit a long"):
        found(spark, [(100, 1, [2**40]), (1, 1, [2**40])], 100)
