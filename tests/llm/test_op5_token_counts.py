"""Token counts of flat files: against the encoder, for every block size, and on odd files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.llm import op5_token_counts as op
from kerbline.llm.op8_bpe import pack

FOLDER = "/root/testdata/sf0.001"


def brute(ids, end):
    docs, start = [], 0
    for at in [*np.flatnonzero(ids == end).tolist(), None]:
        if at is None:
            if start < len(ids):
                docs.append((len(docs), start, len(ids) - start, False))
        else:
            docs.append((len(docs), start, at - start, True))
            start = at + 1
    return docs


def test_query_equals_encoder(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    wanted = sorted(len(pack(t, kind="<u2", added=False)) // 2 for t in texts)
    found = op.query(spark, FOLDER).collect()
    assert sorted(r.n_tokens for r in found) == wanted
    assert all(r.ended for r in found)


@pytest.mark.parametrize("block", [8, 24, 10_000])
@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_blocks_are_stitched(spark, tmp_path, block, kind):
    pick = np.random.default_rng(block)
    end = 50256
    files = {}
    for k in range(4):
        ids = pick.integers(0, 300, 120).astype(kind)
        ids[pick.random(120) < 0.15] = end
        if k == 1:
            ids[-1] = end
        if k == 2:
            ids[ids == end] = 7
        if k == 3:
            ids = ids[:0]
        ids.tofile(tmp_path / f"part-{k}.bin")
        files[k] = ids
    found = op.token_counts(spark, str(tmp_path), end, kind, block).collect()
    for k, ids in files.items():
        ours = sorted((r.doc_index, r.start, r.n_tokens, r.ended) for r in found if r.file.endswith(f"part-{k}.bin"))
        assert ours == brute(ids, end)


def test_bytes_of_the_end_across_two_ids_are_no_end(spark, tmp_path):
    np.array([0x5000, 0x00C4, 50256, 0xC450], "<u2").tofile(tmp_path / "a.bin")
    found = op.token_counts(spark, str(tmp_path), block=4).collect()
    assert sorted((r.start, r.n_tokens) for r in found) == [(0, 2), (3, 0)]


def test_odd_length_is_an_error(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number"):
        op.token_counts(spark, str(tmp_path)).collect()


def test_edges(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "a<|endoftext|>b"), (3, "x " * 50_000), (None, "ab")], "doc_id long, text string"
    )
    op.write_tokens(docs, op.encoded(F.col("text"), kind="<u2", added=False), str(tmp_path / "t"))
    found = sorted(r.n_tokens for r in op.token_counts(spark, str(tmp_path / "t")).collect())
    texts = ["", "", "a<|endoftext|>b", "x " * 50_000, "ab"]
    assert found == sorted(len(pack(t, kind="<u2", added=False)) // 2 for t in texts)
    op.write_tokens(docs.filter("false"), F.lit(None).cast("binary"), str(tmp_path / "e"))
    assert op.token_counts(spark, str(tmp_path / "e")).count() == 0
