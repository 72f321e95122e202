"""Operator 9: n-gram Jaccard self-join with Bayesian candidate pruning.

A document is the set of its word n-grams (words: lower-cased runs of letters and
digits; fewer than n words make one n-gram).  Documents of equal words are one class
with a count; the join runs over the classes.

1. Every class gets ``HASHES`` MinHash values and ``HASHES / ROWS`` band keys.  A pair at
   the threshold shares no band with probability (1 - t**ROWS)**BANDS, 5e-8 at 0.8.
2. The classes of a bucket, those that share a band key, are compared by their signatures in pairs of blocks, each pair of
   blocks a task of its own: MinHash values are compared ``STEP`` at a time, and a pair is dropped as soon as
   the posterior probability (uniform prior) that its similarity reaches the threshold
   falls below ``TOLERANCE``.  Classes that are joined already are not compared again, so a bucket of near copies costs a
   few passes.  Distributed components of what survives are the candidate groups.
3. Only the classes of a group send their n-gram sets.  Pairs of a group, again in pairs of blocks, pass the
   same pruning and are verified exactly.
4. A task gives each class's number of linked documents and a local spanning forest, never
   the pairs; components of the forests are the classes of near copies.

Classes are named by a 64-bit hash of their words; of 10**10 different texts about three pairs
share one by chance and would be taken for copies.

Defined cases: a document that is null, empty or without a letter or digit links with
nothing.  Every input row is a document, repeated rows included, and copies link with each
other.  A null id counts as a link but names no class unless all ids of it are null.  An empty table gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import connected_components

WORDS = 5
THRESHOLD = 0.8
HASHES, ROWS = 128, 4
STEP, TOLERANCE = 16, 1e-8
#: A block has about so many documents, or n-grams, at most.
BLOCK, BLOCK_GRAMS = 1_000, 1_000_000
#: Signatures of a block, half a kilobyte each: a bucket is cut only beyond, as each block travels once for every other.
BLOCK_SIGNATURES = 16_384
SEED = 97

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x100000001B3)


def words_of(text: Column) -> Column:
    """The words, each followed by one space but the last."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def key_of(text: Column, seed: int = SEED) -> Column:
    """Hash of a text's words: the name of its class of copies."""
    return F.xxhash64(words_of(text), F.lit(seed))


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64, on arrays."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def grams(text: bytes, powers: list[np.ndarray], n: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the word n-grams of one document, sorted."""
    if not text:
        return np.empty(0, np.uint64)
    if len(powers[0]) <= len(text):
        powers[:] = _powers(2 * len(text))
    raw = np.frombuffer(text, np.uint8)
    spaces = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], spaces + 1))
    ends = np.concatenate((spaces, [len(raw)]))
    # The hash of a word is the difference of two prefix sums of byte x power, divided by the power at its start.
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * powers[0][:len(raw)], dtype=np.uint64)))
    words = mixed((prefix[ends] - prefix[starts]) * powers[1][starts])
    if len(words) < n:
        words = np.concatenate((words, np.full(n - len(words), len(words), np.uint64)))
    out = words[:len(words) - n + 1]
    for k in range(1, n):
        out = out * _ODD + words[k:len(words) - n + 1 + k]
    return np.unique(mixed(out))


def _powers(size: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        steps = np.full(size, b, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out


def minhash(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(hashes), 1_024):
        values = ((hashes[at:at + 1_024, None] * a + b) >> np.uint64(32)).astype(np.uint32)
        low = np.minimum(low, values.min(axis=0))
    return low


def family(seed: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(0, 1 << 63, hashes, dtype=np.uint64) for _ in range(2))
    return a * np.uint64(2) + np.uint64(1), b


def least_matches(threshold: float = THRESHOLD, hashes: int = HASHES, step: int = STEP, tolerance: float = TOLERANCE) -> list[int]:
    """After step, 2 x step, ... compared values: the fewest matches with which a pair stays.

    With a uniform prior the similarity given m matches of k is Beta(m + 1, k - m + 1), whose
    mass above t is the chance that k + 1 trials of probability t succeed m times at most.
    """
    out = []
    for k in range(step, hashes + 1, step):
        mass = 0.0
        for m in range(k + 1):
            mass += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if mass >= tolerance:
                out.append(m)
                break
    return out


def _signed(df: DataFrame, n: int, hashes: int, seed: int, with_grams: bool) -> DataFrame:
    """Adds ``grams`` (their number), ``sig`` (MinHash values), and the n-gram hashes as ``set`` where asked, to rows
    with ``words``, which go."""
    keep = [c for c in df.columns if c != "words"]
    more = ["grams", "sig", *(["set"] if with_grams else [])]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "grams long", "sig binary", *(["set binary"] if with_grams else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = family(seed, hashes)
        powers = _powers(1 << 16)
        for batch in common.slices(batches):
            sizes, sigs, sets = [], [], []
            for text in batch.column("words"):
                found = grams(text.as_py().encode(), powers, n)
                sizes.append(len(found))
                sigs.append(minhash(found, a, b).tobytes())
                if with_grams:
                    sets.append(found.tobytes())
            made = [pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), *([pa.array(sets, pa.binary())] if with_grams else [])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], [*keep, *more])

    return df.mapInArrow(run, schema)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
                threshold: float = THRESHOLD, hashes: int = HASHES, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """(id_col, key, class_id, n_links, n_copies), one row per input row.

    ``key`` tells texts of different words apart, ``class_id`` is the smallest id of the near copies that
    links reach, ``n_links`` the number of documents linked directly, equal ones included, and
    ``n_copies`` that of documents with the same words.
    """
    common.workers_see_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words")).withColumn("key", F.xxhash64("words", F.lit(seed)))
    signed = common.stored(_signed(texts, n, hashes, seed, with_grams=False), "ngram-signatures")
    classes = signed.filter("grams > 0").groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("low"), F.min("grams").alias("grams"))
    classes = common.stored(classes, "ngram-classes")

    groups = common.stored(_groups(signed, threshold, hashes, rows).join(classes, "key"), "ngram-groups")

    links = common.stored(_verified(texts, groups, n, threshold, hashes, seed), "ngram-links")
    degree = links.groupBy("key").agg(F.sum("links").alias("linked"))
    found = connected_components(links, "key", "root").select(F.col("node").alias("key"), "component")
    named = classes.join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
    lowest = named.groupBy("component").agg(F.min("low").alias("class_id"))
    facts = (named.join(lowest, "component").join(degree, "key", "left")
             .select("key", "class_id", "copies", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    out = signed.select("id", "key", "grams").join(facts, "key", "left")
    return out.select(F.col("id").alias(id_col), "key", F.when(F.col("grams") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"))


def _groups(signed: DataFrame, threshold: float, hashes: int, rows: int) -> DataFrame:
    """(key, grp): the classes that may have a near one, and the smallest key that such pairs reach."""
    sigs = common.stored(signed.filter("grams > 0").groupBy("key").agg(F.first("sig").alias("sig")), "ngram-classes-signed")
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(hashes // rows - 1)), lambda k: F.xxhash64(
        k, F.expr("sig").substr(k * (4 * rows) + 1, F.lit(4 * rows))))).alias("band")
    banded = sigs.select("key", band)
    buckets = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band", F.ceil(F.col("n") / BLOCK_SIGNATURES).cast("int").alias("blocks"))
    members = banded.join(buckets, "band").withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int"))
    task = ["band", "i", "j"]
    pairs = common.block_pairs(members, "blocks", "block").select("key", *task).join(sigs, "key")
    pairs = pairs.repartition(*task).sortWithinPartitions(*task, "key")
    least = least_matches(threshold, hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.runs(batches, task):
            keys = table.column("key").to_numpy()
            roots = keys[joined(np.stack([np.frombuffer(s.as_py(), np.uint32) for s in table.column("sig")]), least)]
            there = np.isin(roots, roots[roots != keys])
            if there.any():
                yield pa.RecordBatch.from_arrays([pa.array(keys[there]), pa.array(roots[there])], ["key", "root"])

    stars = common.stored(pairs.select("key", "sig", *task).mapInArrow(run, "key long, root long").filter("key != root").distinct(), "ngram-stars")
    return connected_components(stars, "key", "root").select(F.col("node").alias("key"), F.col("component").alias("grp"))


def pruned(sig: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows (a, b) of the signatures that the incremental comparison keeps."""
    matches = np.zeros(len(a), np.int16)
    for k, need in enumerate(least):
        stay = np.empty(len(a), bool)
        columns = slice(k * STEP, (k + 1) * STEP)
        for low in range(0, len(a), 65_536):
            part = slice(low, low + 65_536)
            matches[part] += (sig[a[part], columns] == sig[b[part], columns]).sum(axis=1, dtype=np.int16)
            stay[part] = matches[part] >= need
        a, b, matches = a[stay], b[stay], matches[stay]
        if not len(a):
            break
    return a, b


def joined(sig: np.ndarray, least: list[int]) -> np.ndarray:
    """For each signature the first one that kept pairs reach; a pair that others join already is not compared."""
    part = np.arange(len(sig))
    for row in range(len(sig) - 1):
        others = np.flatnonzero(part[row + 1:] != part[row]) + row + 1
        _, near = pruned(sig, np.full(len(others), row), others, least)
        if len(near):
            merged = np.isin(part, part[np.append(near, row)])
            part[merged] = part[merged].min()
            if not part.any():
                break
    return part


def _verified(texts: DataFrame, groups: DataFrame, n: int, threshold: float, hashes: int, seed: int) -> DataFrame:
    """(key, links, root) of the classes that tasks found linked."""
    sizes = groups.groupBy("grp").agg(F.count("*").alias("n"), F.sum("grams").alias("total"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_GRAMS)).cast("int").alias("blocks")
    members = groups.join(sizes.select("grp", blocks), "grp").select("key", F.col("low").alias("id"), "copies", "grp", "blocks")
    # The text of one document of each class in a group, with its n-grams.
    texts = texts.filter(common.bit_filter(groups, "key")(F.col("key")))
    found = texts.join(members.withColumnsRenamed({"key": "k", "id": "i"}).hint("merge"), F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")))
    found = found.select("key", "copies", "grp", "blocks", "words", F.pmod(F.xxhash64("key", F.lit(seed)), F.col("blocks")).cast("int").alias("block"))
    members = _signed(found, n, hashes, seed, with_grams=True)
    task = ["grp", "i", "j"]
    rows = common.block_pairs(members, "blocks", "block").repartition(*task).sortWithinPartitions(*task, "key")
    least = least_matches(threshold, hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.runs(batches, task):
            out = _compare(table, threshold, least)
            if out is not None:
                yield out

    return rows.select("key", "copies", "sig", "set", "block", *task).mapInArrow(run, "key long, links long, root long")


def _compare(table: pa.Table, threshold: float, least: list[int]) -> pa.RecordBatch | None:
    keys = table.column("key").to_numpy()
    once = np.ones(len(keys), bool)  # a class's text can be there more than once where ids repeat
    once[1:] = keys[1:] != keys[:-1]
    if once.sum() < 2:
        return None
    table = table.filter(pa.array(once))
    keys, weights, block = (table.column(c).to_numpy() for c in ("key", "copies", "block"))
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    size = len(keys)
    sig = np.stack([np.frombuffer(s.as_py(), np.uint32) for s in table.column("sig")])
    sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("set")]
    if i == j:
        a, b = np.triu_indices(size, 1)
    else:
        a, b = (x.ravel() for x in np.meshgrid(np.flatnonzero(block == i), np.flatnonzero(block == j), indexing="ij"))
    a, b = pruned(sig, a, b, least)
    if not len(a):
        return None
    # The exact test: n-grams as small numbers, a flag for those of one side.
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    lengths = np.array([len(s) for s in sets])
    ends = np.cumsum(lengths)
    small = [numbers[e - n:e] for e, n in zip(ends, lengths, strict=True)]
    flag = np.zeros(int(numbers.max()) + 1, np.int32)
    linked = np.zeros((size, size), bool)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    cuts = np.flatnonzero(np.diff(a)) + 1
    for others in np.split(np.arange(len(a)), cuts):
        one, rest = a[others[0]], b[others]
        flag[small[one]] = 1
        starts = np.concatenate(([0], np.cumsum(lengths[rest])[:-1]))
        shared = np.add.reduceat(flag[np.concatenate([small[r] for r in rest])], starts)
        flag[small[one]] = 0
        near = rest[shared >= threshold * (lengths[one] + lengths[rest] - shared) - 1e-9]
        linked[one, near] = linked[near, one] = True
    links = linked @ weights
    there = links > 0
    roots = common.local_roots(linked, keys)
    return pa.RecordBatch.from_arrays([pa.array(keys[there]), pa.array(links[there]), pa.array(roots[there])], ["key", "links", "root"])
