"""Operator 11: source divergence audit, by late string materialization.

How far the term frequencies of each source lie from those of the other sources of its
language (part ``pair``), and which terms set it apart from its language (part ``term``).

1. A task counts the terms of its documents in a dictionary of bounded size, and sends out numbers
   only: language, group and term digest, 64 bits each, and the counts.  Languages and groups get
   theirs by a seed under which no two share one.
2. One shuffle by digest sums the counts by group, then by language.  Digests that at least ``MIN_DOCS`` documents
   of a language have may be kept terms; their rows are written.
3. The least and the greatest text of each such digest, taken from one per task that met it, tell whether it stands for one
   term.  Those of a digest with two or more are counted again by their text and numbered apart.
4. Pair values are sums over blocks of terms and blocks of sources: a task fills the matrix
   of its terms and sources, zero counts included, and gives one number per pair of sources.
5. Texts join only what goes out: the first ``TOP`` terms of each group and those tied with the last.

All arithmetic is on whole numbers of 64 bits, exact while a language has fewer than 9e15 terms.

Defined cases: a null text, language or source reads as ''; every row is a document, repeated rows
included; a group without terms is compared by zero counts; a language with one source has no pairs; an empty
table gives no rows.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SEED = 11
#: Entries of a task's dictionary before its rows go out, and rows of a batch.
ENTRIES, ROWS = 800_000, 50_000
#: Bits for each digest in the filter that thins out texts before they join, and bits in all at most.
FILTER_BITS, MOST_BITS = 16, 1 << 24
#: Bytes of a text that are split at once.
SLICE = 1 << 20
#: Terms and sources of a task that sums pairs, and terms of one step of it.
BLOCK_TERMS, BLOCK_SOURCES, STEP = 1_024, 256, 16

#: Bytes of terms: ASCII letters, lower-cased, and all of longer UTF-8 sequences; others separate.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of bounded size."""
    raw = raw.translate(_FOLD)
    low = 0
    while low < len(raw):
        cut = raw.find(b" ", low + SLICE)
        high = len(raw) if cut < 0 else cut
        yield raw[low:high].split()
        low = high


def digests(terms: list[bytes], bits: int = 64) -> np.ndarray:
    found = np.fromiter((xxhash.xxh64_intdigest(t) for t in terms), np.uint64, len(terms))
    return (found if bits == 64 else found & np.uint64((1 << bits) - 1)).view(np.int64)


def _counted(texts: DataFrame, bits: int, with_term: bool = False) -> DataFrame:
    """(l, g, digest, n, docs) of rows (l, g, text), and the term if asked: counts of each term that a task met in a group."""
    names = ["l", "g", "digest", "n", "docs", *(["term"] if with_term else [])]

    def rows(langs: dict, totals: dict, docs: dict) -> Iterator[pa.RecordBatch]:
        for g, total in totals.items():
            terms, met = list(total), docs[g]
            for low in range(0, len(terms), ROWS):
                some = terms[low:low + ROWS]
                columns = [pa.array(np.full(len(some), langs[g])), pa.array(np.full(len(some), g)), pa.array(digests(some, bits)),
                           pa.array([total[t] for t in some], pa.int64()), pa.array([met[t] for t in some], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(some, pa.binary()).cast(pa.string())] if with_term else [])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[int, int] = {}
        totals: dict[int, Counter] = {}
        docs: dict[int, Counter] = {}
        entries = 0
        for batch in common.slices(batches):
            for g, lang, text in zip(batch.column("g").to_pylist(), batch.column("l").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                if g not in totals:
                    langs[g], totals[g], docs[g] = lang, Counter(), Counter()
                total, before = totals[g], len(totals[g])
                met: set[bytes] = set()
                for words in terms_of(text.as_py()):
                    total.update(words)
                    met.update(words)
                docs[g].update(met)
                entries += len(total) - before
                if entries > ENTRIES:
                    yield from rows(langs, totals, docs)
                    langs, totals, docs, entries = {}, {}, {}, 0
        yield from rows(langs, totals, docs)

    return texts.select("l", "g", "text").mapInArrow(run, ", ".join(f"{n} {'string' if n == 'term' else 'long'}" for n in names))


def _named(texts: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """(digest, low, high): the least and the greatest text of each wanted digest."""
    count = wanted.count()
    size = 1 << min(MOST_BITS.bit_length() - 1, max(6, (FILTER_BITS * count).bit_length()))
    spot = F.col("digest").bitwiseAND(F.lit(size - 1))
    words = wanted.groupBy(F.shiftright(spot, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).collect()
    filled = np.zeros(size >> 6, np.int64)
    filled[[w["word"] for w in words]] = [w["bits"] for w in words]
    filled = filled.view(np.uint64)

    def rows(terms: set[bytes]) -> Iterator[pa.RecordBatch]:
        listed = list(terms)
        for low in range(0, len(listed), ROWS):
            some = listed[low:low + ROWS]
            found = digests(some, bits)
            at = found.view(np.uint64) & np.uint64(size - 1)
            asked = (filled[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
            yield pa.RecordBatch.from_arrays([pa.array(found[asked]), pa.array(some, pa.binary()).filter(pa.array(asked)).cast(pa.string())], ["digest", "term"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms: set[bytes] = set()
        for batch in common.slices(batches):
            for text in batch.column("text").cast(pa.binary()):
                for words in terms_of(text.as_py()):
                    terms.update(words)
                if len(terms) > ENTRIES:
                    yield from rows(terms)
                    terms = set()
        yield from rows(terms)

    met = texts.select("text").mapInArrow(run, "digest long, term string")
    return met.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")).join(wanted, "digest")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), by long division in steps of 1000."""
    whole = total + 2 * terms
    rest, out = count + 2, F.lit(0).cast("long")
    for step in (1, 1000, 1000, 1000):
        rest = rest * step
        out = out * step + _div(rest, whole)
        rest = rest % whole
    return out + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _distance(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _groups(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, source, l, g), one row per group, and the seed by which l and g are unique."""
    groups = common.stored(docs.select("lang", "source").distinct(), "divergence-groups")
    for seed in itertools.count(SEED):
        named = groups.withColumns(_numbers(seed))
        n = named.agg(F.count("*").alias("n"), F.count_distinct("g").alias("g"), F.count_distinct("lang").alias("langs"), F.count_distinct("l").alias("l")).first()
        if n["n"] == n["g"] and n["langs"] == n["l"]:
            return named, seed


def _numbers(seed: int) -> dict[str, Column]:
    return {"l": F.xxhash64(F.lit(seed), "lang"), "g": F.xxhash64(F.lit(seed), "lang", "source")}


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS,
          top: int = TOP, digest_bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    common.workers_see_package(docs.sparkSession)
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    groups, seed = _groups(docs)
    docs = docs.withColumns(_numbers(seed))
    sums = F.sum("n").alias("n"), F.sum("docs").alias("docs")
    in_lang = Window.partitionBy("digest", "l")
    # The tasks' dictionaries have combined what they could: rows are dealt by digest, for the sums by group and by language alike.
    counts = _counted(docs, digest_bits).repartition("digest").groupBy("digest", "l", "g").agg(*sums)
    counts = counts.withColumns({"in_lang": F.sum("n").over(in_lang), "docs": F.sum("docs").over(in_lang)}).filter(F.col("docs") >= min_docs)
    have = common.stored(counts.select("digest", "l", "g", "n", "in_lang"), "divergence-counts")
    texts = common.stored(_named(docs, have.select("digest").distinct(), digest_bits), "divergence-texts")

    mixed = texts.filter("low != high").select("digest")
    terms = texts.filter("low = high").select("digest", F.lit(0).alias("k"), F.col("low").alias("term"))
    have = have.withColumn("k", F.lit(0))
    if not mixed.isEmpty():
        # A digest of several terms: these are counted by their text, and numbered from 1 within the digest.
        by_text = Window.partitionBy("digest", "l", "term")
        apart = _counted(docs, digest_bits, with_term=True).join(mixed, "digest").groupBy("digest", "l", "g", "term").agg(*sums)
        apart = apart.withColumns({"in_lang": F.sum("n").over(by_text), "docs": F.sum("docs").over(by_text)}).filter(F.col("docs") >= min_docs)
        apart = apart.withColumn("k", F.dense_rank().over(Window.partitionBy("digest").orderBy("term")))
        apart = common.stored(apart, "divergence-split")
        have = have.join(mixed, "digest", "left_anti").unionByName(apart.select("digest", "l", "g", "n", "in_lang", "k"))
        terms = terms.unionByName(apart.select("digest", "k", "term").distinct())
    kept = common.stored(have.groupBy("l", "digest", "k").agg(F.first("in_lang").alias("in_lang")), "divergence-kept")
    of_lang = kept.groupBy("l").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
    of_group = have.groupBy("g").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    facts = (groups.join(of_lang, "l", "left").join(of_group, "g", "left")
             .select("lang", "source", "l", "g", *(F.coalesce(c, zero).alias(c) for c in ("terms", "lang_total", "total"))))
    facts = common.stored(facts, "divergence-facts")
    shares = have.join(facts.select("g", "terms", "lang_total", "total"), "g").select(
        "l", "g", "digest", "k", "terms", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("in_lang"), F.col("lang_total"), F.col("terms")).alias("q"))
    return _top_terms(shares, facts, terms, top).unionByName(_pairs(shares, kept, facts))


def _top_terms(shares: DataFrame, facts: DataFrame, texts: DataFrame, top: int) -> DataFrame:
    found = shares.filter("p > q").withColumn("value", _distance(F.col("p"), F.col("q")))
    # Ties with the last value stay until the texts decide.
    by_value = Window.partitionBy("g").orderBy(F.desc("value"))
    found = found.withColumn("at", F.rank().over(by_value)).filter(F.col("at") <= top).select("g", "digest", "k", "value")
    found = found.join(texts, ["digest", "k"]).withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "term")))
    return found.filter(F.col("rank") <= top).join(facts.select("g", "lang", "source"), "g").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(shares: DataFrame, kept: DataFrame, facts: DataFrame) -> DataFrame:
    plan = facts.groupBy("l").agg(F.greatest(F.lit(1), F.ceil(F.max("terms") / BLOCK_TERMS)).cast("int").alias("buckets"),
                                  F.ceil(F.count("*") / BLOCK_SOURCES).cast("int").alias("blocks"))
    bucket = F.pmod(F.xxhash64("digest", "k"), F.col("buckets")).cast("int").alias("bucket")
    block = F.pmod(F.xxhash64("g"), F.col("blocks")).cast("int").alias("block")
    sizes = kept.join(plan, "l").groupBy("l", bucket).agg(F.count("*").alias("here"))
    # Every source of the language once in each bucket of terms, with its share of a term that it lacks.
    heads = facts.join(plan, "l").withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))).join(sizes, ["l", "bucket"], "left")
    heads = heads.select("l", "bucket", "g", block, "blocks", F.lit(None).cast("long").alias("digest"), F.lit(0).alias("k"),
                         F.when(F.col("terms") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(1).alias("p"),
                         F.coalesce("here", F.lit(0)).cast("long").alias("here"))
    rows = shares.join(plan, "l").select("l", bucket, "g", block, "blocks", "digest", "k", "p", F.lit(0).cast("long").alias("here"))
    task = ["l", "bucket", "i", "j"]
    rows = common.block_pairs(heads.unionByName(rows), "blocks", "block").drop("blocks")
    rows = rows.repartition(*task).sortWithinPartitions(*task)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.runs(batches, task):
            a, b, value = _summed(table)
            for low in range(0, len(a), ROWS):
                part = slice(low, low + ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(a[part]), pa.array(b[part]), pa.array(value[part])], ["a", "b", "value"])

    sums = rows.mapInArrow(run, "a long, b long, value long").groupBy("a", "b").agg(F.sum("value").alias("value"))
    both = sums.withColumn("way", F.explode(F.array(F.struct(F.col("a").alias("g"), F.col("b").alias("other")), F.struct(F.col("b").alias("g"), F.col("a").alias("other")))))
    named = both.select("way.g", "way.other", "value").join(facts.select("g", "lang", "source"), "g")
    named = named.join(facts.select(F.col("g").alias("other"), F.col("source").alias("item")), "other")
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "item"))
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of the task's sources and the sums of their distances over the task's terms."""
    head = np.asarray(table.column("digest").is_null())
    g, p, block = (table.column(c).to_numpy() for c in ("g", "p", "block"))
    order = np.argsort(g[head])
    sources, absent, blocks = g[head][order], p[head][order], block[head][order]
    names = np.stack([table.column("digest").filter(pa.array(~head)).to_numpy().astype(np.int64), table.column("k").to_numpy()[~head].astype(np.int64)], axis=1)
    terms, at = np.unique(names, axis=0, return_inverse=True) if len(names) else (names, np.empty(0, np.int64))
    matrix = np.tile(absent, (len(terms), 1))
    matrix[at.ravel(), np.searchsorted(sources, g[~head])] = p[~head]
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    one, two = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)

    def distance(x: np.ndarray) -> np.ndarray:
        a, b = x[:, one, None], x[:, None, two]
        return ((a - b) ** 2 // (a + b)).sum(axis=0)

    sums = distance(absent[None, :]) * (table.column("here").to_numpy()[head].max(initial=0) - len(terms))
    for low in range(0, len(terms), STEP):
        sums += distance(matrix[low:low + STEP])
    a, b = np.meshgrid(sources[one], sources[two], indexing="ij")
    there = a < b if i == j else np.ones(a.shape, bool)
    return a[there], b[there], sums[there]


def audit_sql(table: str = "documents") -> str:
    """The same in DuckDB."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text
  FROM {table}),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, r, term, count(*) AS n FROM w GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS in_lang FROM c GROUP BY ALL HAVING count(*) >= {MIN_DOCS}),
l AS (SELECT lang, count(*) AS terms, sum(in_lang) AS lang_total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
have AS (SELECT c.lang, c.source, c.term, sum(c.n) AS n FROM c JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS total FROM have GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n, 1 + CAST({SCALE} AS HUGEINT) * (coalesce(h.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.terms) AS p,
    1 + CAST({SCALE} AS HUGEINT) * (k.in_lang + 2) // (l.lang_total + 2 * l.terms) AS q
  FROM g JOIN kept k USING (lang) JOIN l USING (lang) LEFT JOIN total t USING (lang, source) LEFT JOIN have h USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
