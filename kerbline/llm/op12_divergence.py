"""How sources of a language diverge in their words, by hash-consed segment trees over term ids.

Terms are runs of letters (A-Z lower-cased, everything beyond ASCII counts as a letter). A language keeps
the terms of at least LEAST_DOCS of its documents. Kept terms get ids in descending order of their count, so
that terms missing from small sources lie together. The ids of a language are cut into blocks; a block has
one segment tree for each source and one for the language, with counts as leaves. Trees of a block are
hash-consed: equal subtrees, of one tree or of several, are one node. Two trees are compared by walking both
at once from their roots; pairs of nodes that were met before are not walked again but carry how often they
occur, so each pair of equal counts is priced once for two groups.

With p = 1 + floor(UNIT * (count + 2) / (N + 2 * V)), the price of a term is floor((p - q)^2 / (p + q)),
all in integers. A group is compared with each other source of its language (sums over all kept terms) and
with the language itself (the dearest terms that the group has more often).

Spark counts terms, numbers them in a distributed order and sums blocks. A task holds a block's terms for
two bands of sources: about CELLS counts, however many documents or sources there are, so a hot source or
term is no larger than others there. A group whose documents hold no kept term still has its rows; without
kept terms prices are 0.

Nulls of text, lang and source are read as ''. Repeated rows are documents of their own. Other columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm import words as W
from kerbline.plans.durable import attach, durable
from kerbline.plans.slices import positions

NAME = "op12_divergence"
LEAST_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
#: Bytes of text whose counts a task adds up before it passes them on.
BYTES = 16 * W.SLICE
#: Texts that a task gets at once (Spark's buffer of them doubles as it grows), and counts that it passes on at once.
TEXTS, ROWS = 1_000, 20_000
#: Counts of all groups in one block of terms, and leaves of a block's tree at most.
CELLS = 2**19
LEAVES = 4_096
#: Sources of a language in one band; each two bands are compared in tasks of their own.
BAND = 512
#: Leaf pairs that are walked at once.
PAIRS = 2**20

#: `[^\x00-\x40\x5B-\x60\x7B-\x7F]+` of lower-cased text
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _terms(found: W.Words) -> pa.DictionaryArray:
    """The words as dictionary-encoded strings."""
    sizes = found.ends - found.starts
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(found.starts - ends[:-1], sizes) + np.arange(ends[-1])
    text = pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(found.data[at]))
    )
    return text.dictionary_encode()


def count_terms(docs: DataFrame) -> DataFrame:
    """Counts of all terms: lang, source, term, n, docs (how many documents of the group have the term)."""

    names = ["lang", "source", "term", "n", "docs"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        numbers: dict[tuple[str, str], int] = {}  # of the groups that are held
        size = 0
        for batch in batches:
            langs, sources = (batch[c].dictionary_encode() for c in ("lang", "source"))
            several = max(len(sources.dictionary), 1)
            met, groups = np.unique(
                langs.indices.to_numpy().astype(np.int64) * several + sources.indices.to_numpy(), return_inverse=True
            )
            pairs_met = [langs.dictionary.take(pa.array(met // several)), sources.dictionary.take(pa.array(met % several))]
            pairs_met = [*zip(*(c.to_pylist() for c in pairs_met), strict=True)]
            for begin, end, found in W.lowered(batch["text"], LETTERS):
                terms = _terms(found)
                wide = max(len(terms.dictionary), 1)
                pairs, times = np.unique(found.owners() * wide + terms.indices.to_numpy(), return_counts=True)
                of, term = np.divmod(pairs, wide)
                cells, back = np.unique(groups[begin:end][of] * wide + term, return_inverse=True)
                group, term = np.divmod(cells, wide)
                known = np.array([numbers.setdefault(pair, len(numbers)) for pair in pairs_met], np.int32)
                columns = [pa.array(known[group]), terms.dictionary.take(pa.array(term)).cast(pa.string())]
                columns += [pa.array(np.bincount(back, w, len(cells)).astype(np.int64)) for w in (times, None)]
                held.append(pa.Table.from_arrays(columns, ["group", "term", "n", "docs"]))
                size += len(found.data)
                if size >= BYTES:
                    yield from merged(held, numbers)
                    held, numbers, size = [], {}, 0
        if held:
            yield from merged(held, numbers)

    def merged(held: list[pa.Table], numbers: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
        """Counts of the held slices, handed on in small batches; only these spell out their groups."""
        found = pa.concat_tables(held).group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
        held.clear()
        spelled = [pa.array([pair[i] for pair in numbers], pa.string()) for i in (0, 1)]
        for batch in found.select(["group", "term", "n_sum", "docs_sum"]).to_batches(max_chunksize=ROWS):
            group, *rest = batch.columns
            yield pa.RecordBatch.from_arrays([*(c.take(group) for c in spelled), *rest], names)

    counted = docs.select("text", "lang", "source").mapInArrow(
        count, "lang string, source string, term string, n long, docs long"
    )
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (n + 2) / total) for n + 2 <= total, in three steps that stay within 64 bits."""
    if not len(n):
        return np.zeros(0, np.int64)
    out, rest = np.divmod(n + 2, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + more
    return out + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Forest:
    """Hash-consed segment trees over the same leaves: `counts` has a row per tree, -1 where a leaf is unused."""

    def __init__(self, counts: np.ndarray):
        leaves = 1 << max(counts.shape[1] - 1, 0).bit_length()
        padded = np.full((len(counts), leaves), -1, np.int64)
        padded[:, : counts.shape[1]] = counts
        self.values, level = np.unique(padded, return_inverse=True)
        #: the leaf of each tree at each place, as a place in `values`
        self.leaves = level = level.reshape(padded.shape)
        #: for each level from the leaves up, the children of each node
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        wide = len(self.values)
        while level.shape[1] > 1:
            both = level[:, ::2] * np.int64(wide) + level[:, 1::2]
            nodes, level = np.unique(both, return_inverse=True)
            level = level.reshape(both.shape)
            self.children.append(np.divmod(nodes, wide))
            wide = len(nodes)
        self.roots = level[:, 0]

    def leaf_pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Walk trees a[i] and b[i] at once: i, the two leaves, how often they meet; sorted, each pair once."""
        of, left, right = np.arange(len(a)), self.roots[a], self.roots[b]
        times = np.ones(len(a), np.int64)
        for lefts, rights in reversed(self.children):
            of = np.concatenate([of, of])
            left = np.concatenate([lefts[left], rights[left]])
            right = np.concatenate([lefts[right], rights[right]])
            times = np.concatenate([times, times])
            wide = int(max(left.max(initial=0), right.max(initial=0))) + 1
            pairs, back = np.unique((of * wide + left) * wide + right, return_inverse=True)
            times = np.bincount(back, times, len(pairs)).astype(np.int64)
            both, right = np.divmod(pairs, wide)
            of, left = np.divmod(both, wide)
        used = self.values[left] >= 0
        return of[used], left[used], right[used], times[used]


PRICED = {"lang": pa.string(), "source": pa.string(), "part": pa.string(), "item": pa.string(), "value": pa.int64()}


def _sums(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of integers by sorted owner."""
    ends = np.concatenate([[0], np.cumsum(values)])
    return ends[np.searchsorted(of, np.arange(n), "right")] - ends[np.searchsorted(of, np.arange(n))]


def _pair_prices(forest: Forest, totals: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of prices over the block's terms for trees a[i] and b[i]."""
    step = max(PAIRS // forest.leaves.shape[1], 1)
    values = [np.zeros(0, np.int64)]
    for begin in range(0, len(a), step):
        one, two = a[begin : begin + step], b[begin : begin + step]
        of, x, y, times = forest.leaf_pairs(one, two)
        p = shares(forest.values[x], totals[one][of])
        values.append(_sums(of, prices(p, shares(forest.values[y], totals[two][of])) * times, len(one)))
    return np.concatenate(values)


def _dearest(forest: Forest, totals: np.ndarray, spelled: np.ndarray, top: int) -> list[tuple[int, int, int]]:
    """Tree, place and price of each source's dearest terms; the last tree is the language's."""
    lang, wide, out = len(totals) - 1, len(forest.values), []
    step = max(PAIRS // forest.leaves.shape[1], 1)
    for begin in range(0, lang, step):
        own = np.arange(begin, min(begin + step, lang))
        of, x, y, _ = forest.leaf_pairs(own, np.full(len(own), lang))
        p, q = shares(forest.values[x], totals[own][of]), shares(forest.values[y], np.full(len(of), totals[lang]))
        f = np.where((forest.values[x] > 0) & (p > q), prices(p, q), -1)
        keys = (of * wide + x) * wide + y
        places = (np.arange(len(own))[:, None] * wide + forest.leaves[own]) * wide + forest.leaves[lang]
        found = f[np.searchsorted(keys, places[:, : len(spelled)])]
        for i, row in zip(own.tolist(), found, strict=True):
            has = np.flatnonzero(row >= 0)
            best = has[np.lexsort((spelled[has], -row[has]))[:top]]
            out += [(i, t, v) for t, v in zip(best.tolist(), row[best].tolist(), strict=True)]
    return out


def _priced(block: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """A block's part of all prices between the sources of two bands (or one): lang, source, part, item, value."""
    if not groups.num_rows:  # no source of this language is in these bands
        return pa.table({c: pa.array([], k) for c, k in PRICED.items()})
    groups = groups.sort_by("source").combine_chunks()
    sources, bands = groups["source"].combine_chunks(), groups["band"].to_numpy()
    first, second = np.triu_indices(len(sources), 1)
    alone = groups["alone"][0].as_py()  # one band with itself
    if not alone:
        apart = bands[first] != bands[second]
        first, second = first[apart], second[apart]
    values, dearest = np.zeros(len(first), np.int64), []
    if block.num_rows:
        terms = block.filter(pc.is_null(block["source"])).sort_by("id").combine_chunks()
        cells = block.filter(pc.is_valid(block["source"])).combine_chunks()
        ids, names = terms["id"].to_numpy(), terms["term"].combine_chunks()
        counts = np.zeros((len(sources) + 1, len(ids)), np.int64)
        places = np.searchsorted(ids, cells["id"].to_numpy())
        counts[pc.index_in(cells["source"], sources).to_numpy(), places] = cells["n"].to_numpy()
        counts[-1] = terms["n"].to_numpy()
        forest = Forest(counts)
        totals = np.append(groups["total"].to_numpy(), groups["whole"][0].as_py()) + 2 * groups["v"][0].as_py()
        values = _pair_prices(forest, totals, first, second)
        # A source meets its language where its band meets itself.
        if alone:
            spelled = np.empty(len(ids), np.int64)
            spelled[pc.sort_indices(names.cast(pa.binary())).to_numpy()] = np.arange(len(ids))
            dearest = _dearest(forest, totals, spelled, top)
    of, place, price = np.array(dearest, np.int64).reshape(-1, 3).T
    items = [sources.take(pa.array(np.concatenate([second, first])))]
    if dearest:
        items.append(names.take(pa.array(place)))
    n = 2 * len(first) + len(of)
    return pa.Table.from_arrays(
        [
            pa.array([groups["lang"][0].as_py()] * n, pa.string()),
            sources.take(pa.array(np.concatenate([first, second, of]))),
            pa.array(["pair"] * (n - len(of)) + ["term"] * len(of), pa.string()),
            pa.concat_arrays(items),
            pa.array(np.concatenate([values, values, price])),
        ],
        list(PRICED),
    )


def _counted(plain: DataFrame) -> DataFrame:
    """The counts, stored; the session's batches are as before afterwards."""
    conf, name = plain.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    if 0 < int(before) <= TEXTS:
        return durable(count_terms(plain))
    conf.set(name, TEXTS)
    try:
        return durable(count_terms(plain))
    finally:
        conf.set(name, before)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Divergence of sources (text, lang, source): lang, source, part, item, value, rank.

    Part `pair` has each other source of the language as item, part `term` the `top` dearest terms.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = _counted(plain)
    kept = (
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs)
        .drop("docs")
    )
    kept = durable(positions(durable(kept), ["lang", F.desc("n"), "term"], "id"))
    groups = durable(plain.select("lang", "source").distinct())
    most = groups.groupBy("lang").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    bands = max(-(-most // BAND), 1)
    leaves = 1 << min(LEAVES, max(CELLS // (min(most, 2 * BAND) + 1), 1)).bit_length() - 1
    block = F.expr(f"id div {leaves}")
    cells = durable(
        counts.join(kept.select("lang", "term", "id"), ["lang", "term"]).select("lang", "source", "id", "n")
    )
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("whole"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = attach(attach(groups, totals, ["lang", "source"]), langs, ["lang"])
    facts = durable(named.fillna(0, ["total", "v", "whole"]))
    # Every block of a language meets all its groups; a language without terms has one empty block.
    places = kept.select("lang", block.alias("block")).distinct()
    empty = facts.filter("v = 0").select("lang", F.lit(-1).cast("long").alias("block")).distinct()
    members = attach(places.union(empty), facts, ["lang"], "inner")
    other = F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("other")
    meeting = [F.least("band", "other").alias("i"), F.greatest("band", "other").alias("j")]

    def banded(rows: DataFrame) -> DataFrame:
        """Each row once for every band that its own band meets, itself included."""
        band = F.pmod(F.xxhash64("source"), F.lit(bands)).cast("int").alias("band")
        return rows.select("*", band, other).select(*rows.columns, "band", *meeting)

    leaf = banded(cells.select("lang", block.alias("block"), "source", "id", F.lit(None).cast("string").alias("term"), "n"))
    own = (
        kept.select("lang", block.alias("block"), F.lit(None).cast("string").alias("source"), "id", "term", "n")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("i"))
        .select("*", F.explode(F.sequence("i", F.lit(bands - 1))).alias("j"))
    )
    met = banded(members).withColumn("alone", F.col("i") == F.col("j"))
    keys = ["lang", "block", "i", "j"]

    def price(left: pa.Table, right: pa.Table) -> pa.Table:
        return _priced(left, right, top)

    priced = (
        leaf.drop("band")
        .unionByName(own)
        .groupBy(*keys)
        .cogroup(met.groupBy(*keys))
        .applyInArrow(price, "lang string, source string, part string, item string, value long")
    )
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (
        priced.groupBy("lang", "source", "part", "item")
        .agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(by))
        .filter((F.col("part") == "pair") | (F.col("rank") <= top))
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of the sources of every language."""
    return audit(spark.read.parquet(f"{folder}/documents.parquet"))


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM d
), t AS (
  SELECT r, lang, source,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM w
), kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}
), size AS (
  SELECT lang, count(*) AS v, sum(n) AS whole FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 2)) // (total + 2 * v) AS p,
         1 + ({UNIT}::HUGEINT * (k.n + 2)) // (whole + 2 * v) AS q
  FROM g JOIN kept k ON g.lang = k.lang JOIN size s ON s.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
