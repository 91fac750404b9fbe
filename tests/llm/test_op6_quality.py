"""Quality rules: base numbers and the Kneser-Ney model against brute force, verdicts, edges."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.llm import op6_quality as op

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit), failed)


def brute_model(texts):
    """Modified Kneser-Ney by plain dictionaries; a function of a context and the next byte."""
    grams = Counter()
    for t in texts:
        data = b" " * 4 + b" ".join(t.encode().lower().split()) + b" "
        grams.update(data[i : i + 5] for i in range(len(data) - 4))
    counts = {5: grams}
    for k in (4, 3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts, totals, weights = {}, {}, {}
    for k in range(1, 6):
        n = Counter(counts[k].values())
        if all(n[i] for i in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            d = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
        if not all(n[i] for i in (1, 2, 3, 4)) or any(not 0 < d[i] < i + 1 for i in range(3)):
            d = [0.5, 1.0, 1.5]
        total, weight = defaultdict(int), defaultdict(float)
        for g, c in counts[k].items():
            total[g[:-1]] += c
            weight[g[:-1]] += d[min(c, 3) - 1]
        cuts[k], totals[k], weights[k] = d, total, weight

    def probability(context, byte):
        p = 1 / 256
        for k in range(1, 6):
            h = context[len(context) - k + 1 :] if k > 1 else b""
            if totals[k][h]:
                c = counts[k][h + byte]
                cut = cuts[k][min(c, 3) - 1] if c else 0
                p = (c - cut) / totals[k][h] + weights[k][h] / totals[k][h] * p
        return p

    return probability


@pytest.fixture(scope="module")
def trained(spark):
    pick = random.Random(4)
    texts = [" ".join(pick.choice(["the", "cat", "Été", "sat", "on", "a", "mat"]) for _ in range(40)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    return texts, docs, op.train(docs)


def test_model_equals_brute_force(trained):
    texts, _, models = trained
    for half, model in enumerate(models):
        same(model, brute_model([t for t in texts if op.half(t.encode()) != half]))


def same(model, wanted):
    for context in (b"the ", b" cat", b"zzzz", b"xthe", b"    "):
        codes = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        p = np.exp(model.log_probabilities(codes))
        assert np.allclose(p, [wanted(context, bytes([b])) for b in range(256)], rtol=1e-5)
        assert abs(p.sum() - 1) < 1e-5


def test_loss_is_per_text(trained):
    texts, docs, models = trained

    class Held:
        value = models

    found = {r.doc_id: r.m.nats for r in docs.limit(5).withColumn("m", op.measures(F.col("text"), Held)).collect()}
    for i, nats in found.items():
        wanted = brute_model([t for t in texts if op.half(t.encode()) != op.half(texts[i].encode())])
        data = b" " * 4 + b" ".join(texts[i].encode().lower().split()) + b" "
        logs = [np.log(wanted(data[k : k + 4], data[k + 4 : k + 5])) for k in range(len(data) - 4)]
        assert abs(nats + np.mean(logs)) < 1e-4


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = op.query(spark, FOLDER).collect()
    assert len(found) == len(docs)
    for r in found:
        ours = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert ours == brute_base(docs[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)
    passed = [r for r in found if not r.base_failed]
    assert sum(r.kept for r in passed) > 0.9 * len(passed)


def test_bands_reject_junk(spark):
    pick = random.Random(9)
    junk = " ".join("".join(chr(pick.randrange(33, 127)) for _ in range(7)) for _ in range(60))
    dull = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 1 + "a a b b c c d d e e f f " * 1
    rows = [(9000, junk, "en"), (9001, " ".join(f"the of and th{'and' if k % 3 else 'tion'} of{k}" for k in range(12)), "en"), (9002, dull, "xx")]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    verdict = {r.doc_id: r for r in op.judged(docs.union(spark.createDataFrame(rows, docs.schema))).collect()}
    assert not verdict[9000].kept and verdict[9000].nats > verdict[9000].high
    assert verdict[9001].nats < verdict[9000].nats
    assert verdict[9002].kept  # alone in its language, it is the band


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, None, None, 1), (2, "", "en", 2), (3, " \n ", "en", 3), (4, long, "", 4), (4, long, "", 4),
            (None, "a\na\nb\n\n\na", None, 5), (6, "x " * 40, "de", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int")
    found = op.judged(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        ours = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert ours == brute_base(r.text)
        assert (r.nats is None) == (r.n_words == 0)
    kept = op.reject(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.n_words) for r in kept.collect()) == [(4, 4), (4, 4)]
    assert op.judged(docs.filter("false")).count() == 0
    assert op.reject(docs.filter("false")).count() == 0


def test_more_grams_than_four_million_stay_exact(spark):
    """Random text has millions of different 5-grams; unseen ones must not find a share."""
    made = np.random.default_rng(3)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~", np.uint8)
    texts = [letters[made.integers(0, len(letters), 1_000_000)].tobytes().decode() for _ in range(12)]
    halves = Counter(op.half(t.encode()) for t in texts)
    assert min(halves.values()) >= 5
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for model in op.train(docs.repartition(6)):
        for context in (b"abcd", b"q7#x", texts[0][500:504].encode(), texts[1][900:904].encode()):
            codes = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
            assert abs(np.exp(model.log_probabilities(codes)).sum() - 1) < 1e-4


def test_joined_model_equals_arrays(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").limit(300)
    more = [(None, None, "en"), (-1, "", None), (-2, "twice over", "en"), (-2, "twice over", "en"), (-3, "w" * 5_000_000, "xx")]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    found = []
    for most in ("4000000", "0"):
        spark.conf.set("spark.kerbline.modelRows", most)
        try:
            found.append(sorted(map(repr, op.judged(docs, keep_text=False).collect())))
            kept = sorted(map(repr, op.reject(docs).collect()))
        finally:
            spark.conf.unset("spark.kerbline.modelRows")
        found[-1].append(kept)
    assert found[0] == found[1]


def repeated(spark):
    """Nine of ten documents four times, the tenth once: small counts are rare."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    return docs.withColumn("_k", F.explode(F.expr("sequence(1, if(doc_id % 10 = 0, 1, 4))"))).drop("_k")


@pytest.mark.parametrize("corpus", ["repeated", "sf0.1"])
def test_every_byte_has_a_probability(spark, corpus):
    docs = repeated(spark) if corpus == "repeated" else spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = op.tables(docs)
    pick = np.random.default_rng(8)
    grams = held.grams.filter("half = 0").select("gram").limit(200_000).toPandas()["gram"].to_numpy()
    seen = [int(g) >> 8 for g in pick.choice(grams, 300)]
    contexts = [*seen, int.from_bytes(b"qz\x00~", "big"), int.from_bytes(b"    ", "big")]
    codes = np.array([c << 8 | b for c in contexts for b in range(256)], np.uint64)
    for model in op._fetched(held):
        p = np.exp(model.log_probabilities(codes)).reshape(-1, 256)
        assert (p > 0).all() and np.abs(p.sum(1) - 1).max() < 1e-4
    asked = spark.createDataFrame([(0, int(g)) for g in np.unique(codes[: 40 * 256])], "half int, gram long")
    found = op.probabilities(held, asked)[op.ORDER].groupBy((F.col("gram") / 256).cast("long")).agg(
        F.min("p").alias("low"), F.sum("p").alias("all")
    ).collect()
    assert found and all(r.low > 0 and abs(r["all"] - 1) < 1e-4 for r in found)


def test_repeated_corpus_has_the_same_verdicts_in_both_plans(spark):
    found = []
    for most in ("4000000", "0"):
        spark.conf.set("spark.kerbline.modelRows", most)
        try:
            verdicts = op.judged(repeated(spark), keep_text=False).select("doc_id", F.round("nats", 9), "kept")
            found.append(sorted(map(repr, verdicts.collect())))
        finally:
            spark.conf.unset("spark.kerbline.modelRows")
    assert found[0] == found[1] and not any("inf" in r for r in found[0])
