"""Exact search for a *large* table of queries (X10, X11 as X16 asks them): all pairs in blocks.

Every query meets every document of its key, so the work is the product of both tables.  No pair becomes a
row: documents are dealt to blocks, a task holds the compact arrays of one block and lets the
queries stream past, which come to each block once, sorted by filter key.  Of a block each query keeps its best n,
with all that ties or rounding could still bring among them, and Spark ranks what the blocks kept.
A task's memory is bounded by its block and by a chunk of queries, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ws_tokens
from ..session import workers_see_package
from ..sources import bucketed

#: Scores and distances are ranked after rounding to 6 digits; what is this close to the n-th could still rank before it.
NEAR = 2e-6
#: Documents of a block of vectors.
BLOCK = 16_384
#: Pairs of a chunk: (queries, documents) for a block's distances, exact distances made at once.
PAIRS = 1 << 20
EXACT = 1 << 15
#: A term of so many documents (a share of the block's) is held as a row of all of them.
DENSE = 0.1
#: (queries x documents) that are scored at once, and what a step in single precision can be off by.
CELLS = 1 << 19
EPSILON = 1.2e-7
#: Squares up to here are products in single precision.
FINITE = 1e30
#: Scores from here on round to more than 0.
ABOVE = 5e-7

WORDS, DOCS, QUERIES = -1, 0, 1


def _streams(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(group, kind, rows) of batches sorted by both, cut where either changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        g, kind = (batch.column(c).to_numpy() for c in (group, "kind"))
        cuts = [0, *(np.flatnonzero((g[1:] != g[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            yield int(g[low]), int(kind[low]), batch.slice(low, high - low)


class _Keys:
    """Which documents of a block satisfy a filter key; keys come sorted, so one mask is held."""

    def __init__(self):
        self.parts: list[tuple[int, pa.Array, np.ndarray]] = []
        self.n, self.key, self.mask = 0, None, None

    def add(self, keys: pa.ListArray) -> None:
        at = np.repeat(np.arange(len(keys)), np.nan_to_num(pc.list_value_length(keys).to_numpy(zero_copy_only=False)).astype(np.int64)) + self.n
        self.parts.append((self.n, keys.flatten().dictionary_encode(), at))
        self.n += len(keys)

    def of(self, key: str) -> np.ndarray:
        if self.mask is None or self.key != key:
            self.key, self.mask = key, np.zeros(self.n, bool)
            for _, values, at in self.parts:
                self.mask[at[pc.fill_null(pc.equal(values, key), False).to_numpy(zero_copy_only=False)]] = True
        return self.mask


def first_of_ties(q: np.ndarray, value: np.ndarray, place: np.ndarray, n: int, near: float) -> np.ndarray:
    """Rows, sorted by (q, value, place), that can be among the n least of their q once values are rounded: no further than ``near`` from
    the n-th, and of equal values the first n."""
    order = np.lexsort((place, value, q))
    q, value = q[order], value[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | ~((value[1:] == value[:-1]) | (np.isnan(value[1:]) & np.isnan(value[:-1])))
    tied = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0))
    first = np.searchsorted(q, q, side="left")
    last = np.minimum(first + n, np.searchsorted(q, q, side="right")) - 1
    with np.errstate(invalid="ignore"):
        keep = (rank < n) | ((value <= value[last] + near) & (tied < n))
    return order[keep]


# ------------------------------------------------------------------ vectors
def _square_distances(x: np.ndarray, qs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, document) pairs that can be among the n nearest, from distances by one matrix product, with slack for its error: in single
    precision where no number is beyond it."""
    with np.errstate(all="ignore"):
        xx, qq = (x * x).sum(axis=0), (qs * qs).sum(axis=1)
        most = np.max(xx, initial=0.0) + qq
        if (most < FINITE).all():  # not where one is no number
            d2 = (-2.0 * qs).astype(np.float32) @ x.astype(np.float32)
            d2 += xx.astype(np.float32)
            # The largest of the n best groups' least distances is no less than the n-th distance.
            group = min(64, x.shape[1] // (4 * n)) or 1
            least = d2[:, :x.shape[1] // group * group].reshape(len(qs), group, -1).min(axis=1)
            nth = np.partition(least, n - 1, axis=1)[:, n - 1] + qq if least.shape[1] >= n else np.full(len(qs), np.inf)
            error = (len(x) + 8) * EPSILON * most
            reach = (np.sqrt(np.maximum(nth, 0.0) + error) + NEAR) ** 2 + error - qq
            return np.nonzero(d2 <= (reach + error).astype(np.float32)[:, None])
        d2 = qq[:, None] + xx[None, :] - 2.0 * (qs @ x)
        error = 1e-12 * most
        d2 = np.where(np.isfinite(d2), np.maximum(d2, 0.0), np.inf)
        nth = np.partition(d2, min(n, d2.shape[1]) - 1, axis=1)[:, min(n, d2.shape[1]) - 1]
        reach = (np.sqrt(nth + error) + NEAR) ** 2 + error
    return np.nonzero(~(d2 > np.where(np.isfinite(reach), reach, np.inf)[:, None]))


def _nearest(ids: pa.Array, x: np.ndarray, known: np.ndarray, mask: np.ndarray, numbers: np.ndarray, qs: np.ndarray, n: int):
    """(q, id, distance) batches for queries of one key and dimension; documents without such a vector have no distance and rank first."""
    odd, sound = np.flatnonzero(mask & ~known)[:n], np.flatnonzero(mask & known)
    if len(odd):
        yield np.repeat(numbers, len(odd)), ids.take(pa.array(np.tile(odd, len(numbers)))), pa.nulls(len(odd) * len(numbers), pa.float64())
    if not len(sound):
        return
    vectors = x[:, sound]
    step = max(1, PAIRS // len(sound))
    for low in range(0, len(numbers), step):
        part = qs[low:low + step]
        a, b = _square_distances(vectors, part, n)
        d = np.empty(len(a))
        for k in range(0, len(a), EXACT):
            s = slice(k, k + EXACT)
            with np.errstate(all="ignore"):
                away = vectors[:, b[s]] - part[a[s]].T
                d[s] = np.sqrt(np.add.reduce(away * away, axis=0))  # added up component by component, as in a row
        keep = first_of_ties(a, d, b, n, NEAR)
        yield numbers[low + a[keep]], ids.take(pa.array(sound[b[keep]])), pa.array(d[keep])


def _vector_block(batches: list[pa.RecordBatch], dim: int):
    """(components x documents, which have one of ``dim`` components)."""
    sizes = np.concatenate([np.where(c.is_null().to_numpy(zero_copy_only=False), -1, pc.fill_null(pc.list_value_length(c), -1).to_numpy(zero_copy_only=False)) for c in batches])
    known, x, at = sizes == dim, np.zeros((dim, len(sizes))), 0
    for c in batches:
        own = np.flatnonzero(known[at:at + len(c)])
        if len(own):
            flat = c.take(pa.array(own)).flatten()
            rows = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), dim)
            x[:, at + own] = rows.T
            if flat.null_count:
                known[at + own[flat.is_null().to_numpy(zero_copy_only=False).reshape(len(own), dim).any(axis=1)]] = False
        at += len(c)
    return x, known


def nearest(corpus: DataFrame, queries: DataFrame, n: int, keys: Column) -> DataFrame:
    """(q, id, distance): from each block, what can be among the ``n`` documents nearest by L2 distance to each
    query (q long, qvec, pred_key); distances are exact and not rounded."""
    spark = corpus.sparkSession
    workers_see_package(spark)
    blocks = max(32, -(-corpus.count() // BLOCK))
    numbers = F.array(*map(F.lit, bucketed.spread(spark, blocks)))
    docs = corpus.select(F.get(numbers, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).alias("block"), F.lit(DOCS).alias("kind"), F.col("id").alias("o"),
                         F.lit(None).cast("long").alias("q"), keys.alias("keys"), F.col("embedding").cast("array<double>").alias("v"))
    asked = queries.select(F.explode(numbers).alias("block"), F.lit(QUERIES).alias("kind"), F.col("pred_key").alias("o"), "q",
                           F.lit(None).cast("array<string>").alias("keys"), F.col("qvec").cast("array<double>").alias("v"))
    rows = docs.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind", "o", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors, held, made = None, [], [], _Keys(), {}
        for block, kind, part in _streams(batches, "block"):
            if block != at:
                at, ids, vectors, held, made = block, [], [], _Keys(), {}
            if kind == DOCS:
                ids.append(part.column("o"))
                vectors.append(part.column("v"))
                held.add(part.column("keys"))
                continue
            if not ids:
                continue
            if len(ids) > 1:
                ids = [pa.concat_arrays(ids)]
            v, q = part.column("v"), part.column("q").to_numpy()
            sizes = np.where(v.is_null().to_numpy(zero_copy_only=False), -1, pc.fill_null(pc.list_value_length(v), -1).to_numpy(zero_copy_only=False))
            names = part.column("o").dictionary_encode()
            codes = names.indices.to_numpy()
            for code, key in enumerate(names.dictionary.to_pylist()):
                for dim in np.unique(sizes[codes == code]).tolist():
                    own = np.flatnonzero((codes == code) & (sizes == dim))
                    if dim not in made:
                        made[dim] = _vector_block(vectors, dim) if dim >= 0 else (None, np.zeros(held.n, bool))
                    x, known = made[dim]
                    flat = v.take(pa.array(own)).flatten() if dim >= 0 else None
                    whole = np.ones(len(own), bool)
                    if flat is not None and flat.null_count:
                        whole = ~flat.is_null().to_numpy(zero_copy_only=False).reshape(len(own), dim).any(axis=1)
                    qs = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), dim) if flat is not None else np.zeros((len(own), 0))
                    for some, have in ((whole, known), (~whole, np.zeros(held.n, bool))):
                        if some.any():
                            for a, b, d in _nearest(ids[0], x, have, held.of(key), q[own[some]], qs[some], n):
                                yield pa.RecordBatch.from_arrays([pa.array(a), b, d], ["q", "id", "distance"])

    return rows.mapInArrow(run, "q long, id string, distance double")


# ------------------------------------------------------------------ BM25
class _Block:
    """The documents of a shard by term: for each asked term its documents and their counts.  Words that no query asks for only count
    for a document's length."""

    def __init__(self, k1: float, b: float):
        self.k1, self.b = k1, b
        self.words, self.ids, self.keys, self.parts, self.lengths = [], [], _Keys(), [], []
        self.starts = None

    def code(self, words: pa.Array) -> np.ndarray:
        """Each word's place among the asked ones, -1 for others."""
        if isinstance(self.words, list):
            self.words = pa.concat_arrays(self.words) if self.words else pa.array([], words.type)
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)

    def add(self, part: pa.RecordBatch) -> None:
        tokens, base = part.column("terms"), self.keys.n
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids.append(part.column("o"))
        self.keys.add(part.column("keys"))
        codes = self.code(tokens.flatten())
        asked = codes >= 0
        # Counted within the batch, so what is held is one entry for each term of a document.
        pairs, tf = np.unique(((np.repeat(np.arange(len(sizes)), sizes) + base) | (codes << 32))[asked], return_counts=True)
        self.parts.append(((pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), tf.astype(np.int32)))
        self.lengths.append(sizes)

    def close(self) -> None:
        """Postings in the order of terms, each batch's put to their places and let go."""
        counts = np.zeros(len(self.words), np.int64)
        for codes, _, _ in self.parts:
            counts += np.bincount(codes, minlength=len(counts))
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.doc, self.tf = np.empty(self.starts[-1], np.int32), np.empty(self.starts[-1], np.int32)
        filled = self.starts[:-1].copy()
        for codes, doc, tf in (self.parts.pop(0) for _ in range(len(self.parts))):
            at = filled[codes] + np.arange(len(codes)) - np.searchsorted(codes, codes, side="left")
            self.doc[at], self.tf[at] = doc, tf
            filled += np.bincount(codes, minlength=len(filled))
        self.length = np.concatenate(self.lengths).astype(np.float64)
        self.ids, self.lengths = pa.concat_arrays(self.ids), []
        frequent = np.flatnonzero(counts > DENSE * len(self.length))
        self.row_of = np.full(len(counts), -1)
        self.row_of[frequent] = np.arange(len(frequent))
        self.tf_rows = np.zeros((len(frequent), len(self.length)), np.min_scalar_type(int(self.tf.max(initial=0))))
        for row, term in enumerate(frequent):
            own = slice(self.starts[term], self.starts[term + 1])
            self.tf_rows[row, self.doc[own]] = self.tf[own]

    def weigh(self, avgdl: float) -> None:
        """Every entry's score for weight 1, and those of frequent terms as rows, in single precision."""
        self.norm = self.k1 * ((1 - self.b) + self.b * self.length / avgdl) if avgdl else np.zeros(len(self.length))
        self.impact = self.tf * (self.k1 + 1) / (self.tf + self.norm[self.doc])
        self.rows = np.zeros(self.tf_rows.shape, np.float32)
        for term in np.flatnonzero(self.row_of >= 0):
            own = slice(self.starts[term], self.starts[term + 1])
            self.rows[self.row_of[term], self.doc[own]] = self.impact[own]

    def entries(self, row: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sizes, postings, cells): each term's number of postings, these, and their places among (rows x documents)."""
        first = self.starts[codes]
        sizes = self.starts[codes + 1] - first
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return sizes, at, np.repeat(row * len(self.length), sizes) + self.doc[at]

    def best_of_one(self, codes: np.ndarray, weights: np.ndarray, mask: np.ndarray, n: int):
        """(documents, scores, hits, above, low, high) of one query, from all its scores."""
        sizes, at, cells = self.entries(np.zeros(len(codes), np.int64), codes)
        s = np.bincount(cells, weights=self.impact[at] * np.repeat(weights, sizes), minlength=len(mask)).astype(float, copy=False)
        found = np.flatnonzero(mask & (np.bincount(cells, minlength=len(mask)) > 0))
        if not len(found):
            return None
        s = s[found]
        near = np.flatnonzero(s >= np.partition(s, len(s) - n)[len(s) - n] - NEAR) if len(s) > n else np.arange(len(s))
        keep = near[first_of_ties(np.zeros(len(near), np.int64), -s[near], near, n, NEAR)]
        return found[keep], s[keep], len(s), int((s >= ABOVE).sum()), s.min(), s.max()

    def best(self, row: np.ndarray, codes: np.ndarray, weights: np.ndarray, queries: int, mask: np.ndarray, n: int):
        """(query, documents, scores, hits, above, low, high) of ``queries`` queries of one key, whose terms are ``codes`` in ``row`` order.

        Scores by frequent terms are a product in single precision, which tells the few documents that can be among the best;
        only theirs are exact.  Queries for which that is not enough (weights below 0, hits in all documents, where the least
        score counts, or next to nothing) are scored whole."""
        docs, of = len(mask), np.searchsorted(row, np.arange(queries + 1))
        dense = self.row_of[codes] >= 0
        sizes, at, cells = self.entries(row[~dense], codes[~dense])
        s = np.bincount(cells, weights=self.impact[at] * np.repeat(weights[~dense], sizes), minlength=queries * docs)
        s = s.astype(float, copy=False).reshape(queries, docs)
        rows, about, slack = [], np.zeros((queries, docs), np.float32), np.zeros(queries)
        for i in range(queries):
            own = slice(of[i], of[i + 1])
            rows.append((self.row_of[codes[own]][dense[own]], weights[own][dense[own]]))
            if len(rows[i][0]):
                np.matmul(rows[i][1].astype(np.float32), self.rows[rows[i][0]], out=about[i])
            slack[i] = (len(rows[i][0]) + 4) * EPSILON
        np.add(about, s, out=about, casting="same_kind")
        if not mask.all():
            about *= mask
        hits = np.count_nonzero(about > 0, axis=1)
        whole = (hits == mask.sum()) & (hits > 0) | (np.count_nonzero(about >= 1.02 * ABOVE, axis=1) != hits)
        whole[row[weights <= 0]] = True
        # The least of the n best groups' largest scores is no more than the n-th score.
        group = min(64, docs // (4 * n)) or 1
        least = about[:, :docs // group * group].reshape(queries, group, -1).max(axis=1)
        size = least.shape[1]
        nth = np.partition(least, size - n, axis=1)[:, size - n] if size > n else np.zeros(queries)
        reach = nth - NEAR - 2 * slack * about.max(axis=1, initial=0)
        query, doc = np.nonzero(about >= np.maximum(reach, np.finfo(np.float32).tiny).astype(np.float32)[:, None])
        exact, cut = s[query, doc], np.searchsorted(query, np.arange(queries + 1))
        for i, (some, w) in enumerate(rows):
            if len(some) and cut[i] < cut[i + 1] and not whole[i]:
                own = doc[cut[i]:cut[i + 1]]
                tf = self.tf_rows[some[:, None], own].astype(np.float64)
                exact[cut[i]:cut[i + 1]] += w @ (tf * (self.k1 + 1) / (tf + self.norm[own]))
        keep = first_of_ties(query, -exact, doc, n, NEAR)
        keep = keep[~whole[query[keep]]]
        high = np.zeros(queries)
        np.maximum.at(high, query[keep], exact[keep])
        # Some document has no hit, so the least score is 0.
        yield query[keep], doc[keep], exact[keep], hits[query[keep]], hits[query[keep]], np.zeros(len(keep)), high[query[keep]]
        for i in np.flatnonzero(whole).tolist():
            found = self.best_of_one(codes[of[i]:of[i + 1]], weights[of[i]:of[i + 1]], mask, n)
            if found:
                yield np.full(len(found[0]), i), found[0], found[1], *(np.full(len(found[0]), f) for f in found[2:])


def best_in_shards(corpus: DataFrame, terms: DataFrame, shard: Column, shards: list[int], n: int, k1: float, b: float, keys: Column) -> DataFrame:
    """(q, shard, id, s, hits, above, low, high), not rounded, as :func:`postings.best_in_shards` has them (``low`` is 0 where a document of the
    shard has no hit): ``terms`` are the queries' weighted terms, and the documents' terms are counted where their shard lies."""
    spark = corpus.sparkSession
    workers_see_package(spark)
    none = {c: F.lit(None).cast(k).alias(c) for c, k in (("q", "long"), ("keys", "array<string>"), ("avgdl", "double"), ("weights", "array<double>"), ("terms", "array<string>"))}
    at = F.explode(F.array(*map(F.lit, shards))).alias("shard")
    docs = corpus.select(shard.alias("shard"), F.lit(DOCS).alias("kind"), F.col("id").alias("o"), none["q"], keys.alias("keys"),
                         ws_tokens("document").alias("terms"), none["weights"], none["avgdl"])
    words = terms.select("term").distinct().select(at, F.lit(WORDS).alias("kind"), F.col("term").alias("o"), *(none[c] for c in ("q", "keys", "terms", "weights", "avgdl")))
    asked = terms.groupBy("q", "pred_key").agg(F.collect_list(F.struct("term", "weight")).alias("c"), F.first("avgdl").alias("avgdl"))
    asked = asked.select(at, F.lit(QUERIES).alias("kind"), F.col("pred_key").alias("o"), "q", none["keys"],
                         F.col("c.term").alias("terms"), F.col("c.weight").alias("weights"), "avgdl")
    rows = words.unionByName(docs).unionByName(asked).repartition(len(shards), "shard").sortWithinPartitions("shard", "kind", "o", "q")

    def answers(block: _Block, part: pa.RecordBatch, key: str | None):
        """The best documents of the queries, key by key; with each key's name."""
        names = part.column("o").to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(part.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
        codes, weights = block.code(part.column("terms").flatten()), part.column("weights").flatten().to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        codes, weights, row = (x[codes >= 0] for x in (codes, weights, row))
        step = max(1, CELLS // block.keys.n)
        low = 0
        while low < len(names):
            high = low + 1
            while high < min(low + step, len(names)) and names[high] == names[low]:
                high += 1
            if names[low] != key:
                key = names[low]
                block.weigh(part.column("avgdl")[low].as_py())
            own = slice(*np.searchsorted(row, [low, high]))
            for query, *rest in block.best(row[own] - low, codes[own], weights[own], high - low, block.keys.of(key), n):
                yield key, query + low, *rest
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block, key = None, _Block(k1, b), None
        for number, kind, part in _streams(batches, "shard"):
            if number != here:
                here, block, key = number, _Block(k1, b), None
            if kind == WORDS:
                block.words.append(part.column("o"))
                continue
            if kind == DOCS:
                for low in range(0, part.num_rows, 2048):
                    block.add(part.slice(low, 2048))
                continue
            if not block.keys.n:
                continue
            if block.starts is None:
                block.close()
            q = part.column("q").to_numpy()
            for key, query, doc, s, *facts in answers(block, part, key):
                if len(query):
                    yield pa.RecordBatch.from_arrays([pa.array(q[query]), pa.array(np.full(len(query), number, np.int32)), block.ids.take(pa.array(doc)), pa.array(s),
                                                      *(pa.array(f) for f in facts)], ["q", "shard", "id", "s", "hits", "above", "low", "high"])

    return rows.mapInArrow(run, "q long, shard int, id string, s double, hits long, above long, low double, high double")
