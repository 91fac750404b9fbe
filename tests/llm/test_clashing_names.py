"""Columns named like internals, or with a dot, pass unharmed through the operators that return documents."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbline.llm import op2_winnowing, op3_simhash, op6_quality, op9_secrets

NAMES = [
    "text_key", "row", "_row", "_fingerprint", "_root", "_low", "_high", "_reach", "_lang", "m", "_block", "nats2",
    "token_ids", "decoded", "a.b", "of", "half", "gram", "prints", "words", "_digest",
]
TEXT = "the old ferry crossed the wide river while seven quiet children counted painted boats near %d stone houses again "


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, (TEXT % (i % 7)) * 3 + f"ending{i % 5}", "en") for i in range(40)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    extra = [F.concat(F.lit(f"{n}:"), F.col("doc_id")).alias(n) for n in NAMES]
    return made.select("*", *extra).cache()


STAGES = {
    "decontaminate": lambda s, d: op2_winnowing.decontaminate(d, s.createDataFrame([("q", "no such passage here")], "item_id string, text string")),
    "deduplicate": lambda s, d: op3_simhash.deduplicate(d),
    "reject": lambda s, d: op6_quality.reject(d),
    "judged": lambda s, d: op6_quality.judged(d),
    "redact": lambda s, d: op9_secrets.redact(d),
    "tokens": lambda s, d: corpus_pipeline.tokens(s, d, ""),
}


@pytest.mark.parametrize("most", ["4000000", "0"])
@pytest.mark.parametrize("stage", STAGES)
def test_names_survive(spark, docs, stage, most):
    if most == "0" and stage not in ("reject", "judged"):
        pytest.skip("one plan")
    spark.conf.set("spark.kerbline.modelRows", most)
    try:
        found = STAGES[stage](spark, docs)
        assert found.columns[: len(docs.columns)] == docs.columns
        out = found.collect()
    finally:
        spark.conf.unset("spark.kerbline.modelRows")
    assert out or stage == "reject"
    for row in out:
        assert [row[n] for n in NAMES] == [f"{n}:{row.doc_id}" for n in NAMES]
