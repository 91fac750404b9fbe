"""The pipeline against brute-force versions of its stages, each on its own input."""

import hashlib

import numpy as np
from test_op2_winnowing import brute
from test_op3_simhash import brute_groups, brute_print
from test_op6_quality import brute_base
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as pipeline
from kerbline.llm import op6_quality, op8_bpe, op9_secrets

FOLDER = "/root/testdata/sf0.001"


def test_every_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, kept[-1], FOLDER).write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < 4:
            assert kept[-1].columns == columns
    rows = [{r.doc_id: r for r in df.collect()} for df in kept]

    judged = {r.doc_id: r for r in op6_quality.judged(docs).collect()}
    assert set(rows[1]) == {d for d, r in judged.items() if r.kept}
    assert not any(brute_base(rows[1][d].text)[-1] for d in rows[1])

    ids = sorted(rows[1])
    groups = brute_groups([brute_print(rows[1][d].text) for d in ids])
    assert set(rows[2]) == {ids[g] for g in groups}

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(rows[3]) == {d for d, r in rows[2].items() if not brute(r.text, items)[-1]}

    assert set(rows[4]) == set(rows[3])
    for d, r in rows[4].items():
        assert r.text == op9_secrets.mask(rows[3][d].text) and r.n_chars == len(r.text)

    library = Tokenizer.from_file(op8_bpe.VOCABULARY)
    assert set(rows[5]) == set(rows[4])
    for d, r in rows[5].items():
        coded = library.encode(rows[4][d].text, add_special_tokens=False).ids
        assert r.n_tokens == len(coded)
        assert r.ids_sha256 == hashlib.sha256(np.array(coded, "<u4").tobytes()).hexdigest()

    ran = {r.doc_id: r for r in __spark_entry__.queries()["pipeline"](spark, FOLDER).collect()}
    assert ran == rows[5]


def test_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("false")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").filter("false").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_nulls_and_extra_columns(spark, tmp_path):
    rows = [(1, None, None, "s", None, 1), (1, None, None, "s", None, 1), (None, None, "en", None, 3, None)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens int"
    )
    for _, stage in pipeline.STAGES[1:4]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        out.collect()
    assert pipeline.quality(spark, docs, FOLDER).count() == 0
    assert pipeline.tokens(spark, docs, FOLDER).count() == 3
