"""A persisted inverted index for BM25 (X11, J3, A14), kept up by batches.

Documents are dealt to shards by the hash of their id.  All tables lie under one path:

``docs``      (shard, doc, id, dl, keys, batch), bucketed by shard: every document with its number in the shard,
              its length and the filter keys it satisfies;
``postings``  (shard, term, doc, tf, dl, batch), bucketed by shard, sorted by term;
``bounds``    (term, shard, most_tf, least_dl, batch), bucketed by term: what bounds a term's score in a shard,
              whatever the key, its average length and the parameters;
``terms``     (pred_key, term, df, batch) and ``sizes`` (pred_key, docs, length, batch), to be summed over batches;
``totals``    (pred_key, n, avgdl, avg_idf), made anew after each batch.

A batch is a folder of each table, and writing it again replaces it: a repeated batch changes nothing.

Scoring happens where a shard lies.  Query terms travel to the shards; postings, scores and the cut to
the best n of a query in a shard do not move, and only those n rows and a few numbers per (query, shard) are
exchanged.  Where all weights are positive and some document surely has no query term, a threshold comes first: the
n-th best score by the query's rarest term alone.  A posting whose own score and the bounds of the query's other terms
in its shard do not reach the threshold cannot belong to one of the n best, and is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranking import top_n
from ..functions.text import term_counts, ws_tokens
from ..session import fresh_path, materialize, path_exists
from ..sources import bucketed
from ..sources.bucketed import Layout
from . import batch as blocks

# --- fixed values: BM25 (Okapi) defaults -----------------------------------------
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
# Scores are rounded before ranking so summation order cannot reorder ties.
SCORE_DIGITS = 6
ALL_KEY = "all"
#: Scores this much below the threshold still count as reaching it (rounding).
SLACK = 1e-5

#: Up to so many values a Parquet scan looks for each of a list's, and for their range beyond.
IN_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"

SCHEMAS = {
    "docs": ("shard int, doc long, id string, dl int, keys array<string>, batch string", ("shard",), ("id",)),
    "postings": ("shard int, term string, doc long, tf int, dl int, batch string", ("shard",), ("term", "doc")),
    "bounds": ("term string, shard int, most_tf int, least_dl int, batch string", ("term",), ("term",)),
    "terms": ("pred_key string, term string, df long, batch string", ("term",), ("term",)),
    "sizes": ("pred_key string, docs long, length long, batch string", ("pred_key",), ()),
}


#: The documents of a batch with their counted terms, while it is written.
COUNTS = "shard int, doc long, id string, dl int, keys array<string>, counts array<struct<term:string,tf:bigint>>"

#: As many different terms of a search are named to the scans, whose sorted files are read around them only.
NAMED_TERMS = 400


@dataclass(frozen=True)
class Postings:
    """The tables of an index at ``path``; with ``terms``, those rows of them that belong to these."""
    spark: SparkSession
    path: str
    terms: tuple[str, ...] | None = None

    def table(self, name: str) -> DataFrame:
        rows = bucketed.open_table(self.spark, f"{self.path}/{name}")
        return rows if self.terms is None or "term" not in rows.columns else rows.where(F.col("term").isin(*self.terms))

    def for_terms_of(self, queries: DataFrame) -> Postings:
        """This index for a search: its scans are told the queries' terms where these are few."""
        found = queries.select(F.explode(ws_tokens("query")).alias("term")).distinct().limit(NAMED_TERMS + 1).collect()
        return self if len(found) > NAMED_TERMS else Postings(self.spark, self.path, tuple(sorted(r["term"] for r in found)))

    @property
    def shards(self) -> int:
        return bucketed.layout_of(self.spark, f"{self.path}/docs").buckets

    @property
    def totals(self) -> DataFrame:
        return self.spark.read.schema("pred_key string, n long, avgdl double, avg_idf double").parquet(f"{self.path}/totals")


def create(spark: SparkSession, path: str, shards: int | None = None) -> Postings:
    """An empty index of so many shards (:func:`bucketed.default_buckets` otherwise)."""
    shards = shards or bucketed.default_buckets(spark)
    for name, (schema, keys, order) in SCHEMAS.items():
        bucketed.create(spark, f"{path}/{name}", Layout(schema, keys, shards if name != "sizes" else 1, ("batch",), order))
    spark.createDataFrame([], "pred_key string, n long, avgdl double, avg_idf double").write.mode("overwrite").parquet(f"{path}/totals")
    return Postings(spark, path)


def opened(spark: SparkSession, path: str) -> Postings | None:
    """The index at ``path``, none where it is not written yet."""
    return Postings(spark, path) if path_exists(spark, f"{path}/totals/_SUCCESS") else None


def shard_of(index: Postings, id_col: str = "id") -> Column:
    """The shard that a document of this id lies in."""
    return F.get(F.array(*map(F.lit, bucketed.spread(index.spark, index.shards))), F.pmod(F.xxhash64(id_col), F.lit(index.shards)).cast("int"))


def _idf(n: Column, df: Column) -> Column:
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def _sum_up(index: Postings) -> None:
    """Write ``totals`` from the batches' sums."""
    sizes = index.table("sizes").groupBy("pred_key").agg(F.sum("docs").alias("n"), (F.sum("length") / F.sum("docs")).alias("avgdl"))
    df = index.table("terms").groupBy("term", "pred_key").agg(F.sum("df").alias("df"))
    idf = df.join(sizes, "pred_key").groupBy("pred_key").agg(F.avg(_idf(F.col("n"), F.col("df"))).alias("avg_idf"))
    made = materialize(sizes.join(idf, "pred_key", "left"), "bm25-totals")
    made.select("pred_key", "n", "avgdl", "avg_idf").coalesce(1).write.mode("overwrite").parquet(f"{index.path}/totals")


def add_batch(index: Postings, corpus: DataFrame, batch: str, keys: DataFrame | None = None) -> None:
    """Index the documents of ``corpus`` (id, document, and ``pred_keys`` where queries carry filters) that other batches lack,
    as ``batch``; ids are unique.  ``keys`` (one column ``pred_key``) restricts the filter keys that statistics are kept for.

    Terms are counted inside each row, and the one shuffle of documents moves the counts, to the shards.  They are stored as they lie there, so
    postings are written, and bounds summed up, by the tasks that read a shard's counts: no posting is shuffled."""
    spark = index.spark
    docs_table = index.table("docs").where(F.col("batch") != batch)
    shards = index.shards
    pred = F.col("pred_keys") if "pred_keys" in corpus.columns else F.array(F.lit(ALL_KEY))
    counted = corpus.select("id", pred.alias("keys"), shard_of(index).alias("shard"),
                            term_counts(ws_tokens("document")).alias("counts"))
    counted = counted.withColumn("dl", F.coalesce(F.aggregate("counts", F.lit(0).cast("long"), lambda n, c: n + c["tf"]), F.lit(0)).cast("int"))
    with bucketed.by_bucket(spark):
        counted = counted.repartition(shards, "shard").join(docs_table.select("shard", "id"), ["shard", "id"], "left_anti")
        base = docs_table.groupBy("shard").agg((F.max("doc") + 1).alias("base"))
        place = F.row_number().over(Window.partitionBy("shard").orderBy("id")) - 1
        counted = counted.withColumn("place", place).join(base, "shard", "left").withColumn("doc", F.coalesce("base", F.lit(0)) + F.col("place"))
        scratch = fresh_path(spark, "bm25-counts")
        bucketed.create(spark, scratch, Layout(COUNTS, ("shard",), shards))
        bucketed.append(counted, scratch)
    counted = bucketed.open_table(spark, scratch)
    name = F.lit(batch).alias("batch")
    docs = counted.select("shard", "doc", "id", "dl", "keys", name)
    terms = counted.select("shard", "doc", "dl", "keys", F.explode("counts").alias("c")).select(
        "shard", F.col("c.term").alias("term"), "doc", F.col("c.tf").cast("int").alias("tf"), "dl", "keys")
    rows = terms.select("shard", "term", "doc", "tf", "dl", name)
    # Documents of equal keys are counted together before a key stands for itself.
    alike = terms.groupBy("shard", "term", "keys").agg(F.count(F.lit(1)).alias("n"))
    expanded = alike.select(F.explode("keys").alias("pred_key"), "term", "n")
    lengths = docs.select(F.explode("keys").alias("pred_key"), "dl")
    if keys is not None:
        expanded, lengths = (d.join(keys, "pred_key", "left_semi") for d in (expanded, lengths))
    parts = {
        "docs": docs, "postings": rows,
        "bounds": rows.groupBy("term", "shard").agg(F.max("tf").alias("most_tf"), F.min("dl").alias("least_dl")).withColumn("batch", name),
        "terms": expanded.groupBy("term", "pred_key").agg(F.sum("n").alias("df")).withColumn("batch", name),
        "sizes": lengths.groupBy("pred_key").agg(F.count(F.lit(1)).alias("docs"), F.sum("dl").cast("long").alias("length")).withColumn("batch", name),
    }
    for table, part in parts.items():
        layout = bucketed.layout_of(spark, f"{index.path}/{table}")
        with bucketed.as_it_lies(spark):
            bucketed.append(part if layout.keys == ("shard",) else bucketed.dealt(part, layout), f"{index.path}/{table}", overwrite_partitions=True)
    bucketed.forget(spark, scratch)
    _sum_up(index)


def build(corpus: DataFrame, path: str | None = None, keys: DataFrame | None = None, shards: int | None = None) -> Postings:
    """The index of a corpus, at ``path`` (by default one that goes with the query's other tables)."""
    spark = corpus.sparkSession
    index = create(spark, path or fresh_path(spark, "bm25-index"), shards)
    add_batch(index, corpus, "0", keys)
    return index


# ------------------------------------------------------------------------ scoring
def _impact(tf: Column, dl: Column, avgdl: Column, k1: float, b: float) -> Column:
    return tf * F.lit(k1 + 1) / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / avgdl))


def weights(index: Postings, queries: DataFrame, epsilon: float) -> DataFrame:
    """(q, pred_key, term, df, n, weight, avgdl) of each query's terms that its key's documents have; weight is how often
    the query has it x idf, a negative idf being ``epsilon`` times the mean over the vocabulary."""
    asked = queries.select("q", "pred_key", F.explode(term_counts(ws_tokens("query"))).alias("c")).select("q", "pred_key", "c.term", F.col("c.tf").alias("qtf"))
    df = index.table("terms").join(asked.select("term", "pred_key").distinct(), ["term", "pred_key"], "left_semi")
    df = df.groupBy("term", "pred_key").agg(F.sum("df").alias("df"))
    idf = _idf(F.col("n"), F.col("df"))
    weight = F.col("qtf") * F.when(idf < 0, F.col("avg_idf") * epsilon).otherwise(idf)
    return asked.join(df, ["term", "pred_key"]).join(index.totals, "pred_key").select("q", "pred_key", "term", "df", "n", weight.alias("weight"), "avgdl")


def _at_shards(index: Postings, terms: DataFrame, k1: float, b: float) -> DataFrame:
    """The query terms once for each shard that has them, with the most they can score there."""
    bounds = index.table("bounds").join(terms.select("term").distinct(), "term", "left_semi")
    bounds = bounds.groupBy("term", "shard").agg(F.max("most_tf").alias("most_tf"), F.min("least_dl").alias("least_dl"))
    most = F.col("weight") * _impact(F.col("most_tf"), F.col("least_dl"), F.col("avgdl"), k1, b)
    return terms.join(bounds, "term").withColumn("most", most).drop("most_tf", "least_dl").repartition(index.shards, "shard")


def _scored(index: Postings, at: DataFrame, k1: float, b: float) -> DataFrame:
    """The postings that the query terms meet in their shards, with their scores."""
    rows = index.table("postings").join(at, ["shard", "term"])
    rows = rows.join(index.table("docs").select("shard", "doc", "keys"), ["shard", "doc"]).where(F.array_contains("keys", F.col("pred_key")))
    return rows.withColumn("score", F.col("weight") * _impact(F.col("tf"), F.col("dl"), F.col("avgdl"), k1, b))


def thresholds(index: Postings, terms: DataFrame, n: int, k1: float, b: float) -> DataFrame:
    """(q, reach): a score that at least n documents reach, by one term alone, for queries where pruning is exact: all weights are
    positive, and the terms' documents are fewer than all, so that some document scores 0."""
    facts = terms.groupBy("q").agg(F.min("weight").alias("least"), F.sum("df").alias("hits"), F.first("n").alias("n"),
                                   F.min(F.when(F.col("df") >= n, F.struct("df", "term"))).alias("rarest"), F.count(F.lit(1)).alias("size"))
    fit = facts.where((F.col("least") > 0) & (F.col("hits") < F.col("n")) & F.col("rarest").isNotNull() & (F.col("size") > 1))
    probes = terms.join(fit.select("q", F.col("rarest.term").alias("term")), ["q", "term"])
    found = _scored(index, _at_shards(index, probes, k1, b), k1, b).select("shard", "q", "score")
    best = top_n(found, ["shard", "q"], [F.desc("score")], n, "at").drop("at")
    return top_n(best, ["q"], [F.desc("score")], n, "at").where(F.col("at") == n).select("q", F.col("score").alias("reach"))


def best_in_shards(index: Postings, terms: DataFrame, n: int, k1: float, b: float, prune: bool = True) -> DataFrame:
    """(q, shard, id, s, hits, above, low, high, gap): each shard's best n documents of each query by score and id, beside the shard's number of
    hits, of those above 0, and the range of scores; ``gap`` tells that pruning left these incomplete and some document scores 0."""
    spark = index.spark
    others = F.sum("most").over(Window.partitionBy("q", "shard")) - F.col("most")
    with bucketed.by_bucket(spark), bucketed.setting(spark, IN_THRESHOLD, str(NAMED_TERMS)):
        reach = materialize(thresholds(index, terms, n, k1, b), "bm25-thresholds") if prune else spark.createDataFrame([], "q long, reach double")
        at = _at_shards(index, terms.join(reach, "q", "left"), k1, b).withColumn("others", others)
        can_reach = lambda c: F.col("reach").isNull() | (F.col(c) + F.col("others") >= F.col("reach") - SLACK)
        rows = _scored(index, at.where(can_reach("most")), k1, b).where(can_reach("score"))
        hits = rows.groupBy("shard", "q", "doc").agg(F.round(F.sum("score"), SCORE_DIGITS).alias("s"), F.first(F.col("reach").isNotNull()).alias("gap"))
        here = Window.partitionBy("shard", "q")
        hits = hits.withColumn("at", F.rank().over(here.orderBy(F.desc("s")))).withColumns({
            "hits": F.count(F.lit(1)).over(here), "above": F.count_if(F.col("s") > 0).over(here), "low": F.min("s").over(here), "high": F.max("s").over(here)})
        # Ties with the n-th stay until ids decide.
        hits = hits.where(F.col("at") <= n).join(index.table("docs").select("shard", "doc", "id"), ["shard", "doc"])
        best = top_n(hits, ["shard", "q"], [F.desc("s"), F.asc("id")], n, "at")
        return materialize(best.select("q", "shard", "id", "s", "hits", "above", "low", "high", "gap"), "bm25-best")


def best_of_blocks(index: Postings, corpus: DataFrame, terms: DataFrame, n: int, k1: float, b: float) -> DataFrame:
    """The same for many queries, over the documents of the index themselves: no score becomes a row (:mod:`commentspark.operators.batch`)."""
    keys = F.col("pred_keys") if "pred_keys" in corpus.columns else F.array(F.lit(ALL_KEY))
    found = blocks.best_in_shards(corpus, terms, shard_of(index), bucketed.spread(index.spark, index.shards), n, k1, b, keys)
    rounded = {c: F.round(c, SCORE_DIGITS) for c in ("s", "low", "high")}
    return materialize(found.withColumns({**rounded, "gap": F.lit(False)}), "bm25-best")


def _first_others(index: Postings, queries: DataFrame, best: DataFrame, terms: DataFrame, n: int, k1: float, b: float) -> DataFrame:
    """(q, id): documents without a hit, the first n by id of each query's key, for queries (q, pred_key, hits).

    Of the first hits + n documents of a shard, n have no hit; each query counts that far in each shard, no further."""
    docs = index.table("docs").select("shard", "doc", "id", F.explode("keys").alias("pred_key")).join(queries.select("pred_key").distinct(), "pred_key", "left_semi")
    placed = docs.withColumn("place", F.row_number().over(Window.partitionBy("shard", "pred_key").orderBy("id")))
    in_shard = best.groupBy("q", "shard").agg(F.first("hits").alias("here"))
    shards = F.array(*map(F.lit, bucketed.spread(index.spark, index.shards)))
    wanted = queries.select("q", "pred_key", F.explode(shards).alias("shard")).join(in_shard, ["q", "shard"], "left")
    wanted = wanted.withColumn("place", F.explode(F.sequence(F.lit(1), F.coalesce("here", F.lit(0)).cast("int") + n)))
    with bucketed.by_bucket(index.spark), bucketed.setting(index.spark, IN_THRESHOLD, str(NAMED_TERMS)):
        met = _scored(index, _at_shards(index, terms.join(queries.select("q"), "q", "left_semi"), k1, b), k1, b).select("shard", "q", "doc").distinct()
        rest = placed.join(wanted, ["shard", "pred_key", "place"]).join(met, ["shard", "q", "doc"], "left_anti")
        rest = top_n(rest, ["shard", "q"], [F.asc("id")], n, "at")
        return materialize(top_n(rest, ["q"], [F.asc("id")], n, "at").select("q", "id"), "bm25-others")


def search(index: Postings, queries: DataFrame, n: int = 10, k1: float = BM25_K1, b: float = BM25_B, epsilon: float = BM25_EPSILON,
           prune: bool = True, corpus: DataFrame | None = None) -> DataFrame:
    """(query_id, rank, id, score, distance) of the best ``n`` documents of each query (query_id, query, pred_key).  With ``corpus``, the documents
    that the index holds, queries may be as many as documents: they are scored in blocks."""
    qk = queries.select("query_id", "query", F.coalesce("pred_key", F.lit(ALL_KEY)).alias("pred_key"))
    qk = materialize(qk.withColumn("q", F.monotonically_increasing_id()), "bm25-questions")
    index = index.for_terms_of(qk)
    with bucketed.setting(index.spark, IN_THRESHOLD, str(NAMED_TERMS)):
        terms = materialize(weights(index, qk, epsilon), "bm25-terms")
    best = best_in_shards(index, terms, n, k1, b, prune) if corpus is None else best_of_blocks(index, corpus, terms, n, k1, b)

    by_shard = best.groupBy("q", "shard").agg(*(F.first(c).alias(c) for c in ("hits", "above", "low", "high", "gap")))
    sums = by_shard.groupBy("q").agg(F.sum("hits").alias("hits"), F.sum("above").alias("above"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("gap").alias("gap"))
    facts = qk.join(index.totals, "pred_key").join(sums, "q", "left")
    hits, zero = F.coalesce("hits", F.lit(0)), F.lit(0.0)
    gap = F.coalesce("gap", F.lit(False)) | (hits < F.col("n"))  # a document without a hit scores 0
    facts = materialize(facts.select(
        "q", "query_id", "pred_key", hits.alias("hits"), F.coalesce("above", F.lit(0)).alias("above"), gap.alias("gap"),
        F.when(gap, F.least(F.coalesce("low", zero), zero)).otherwise(F.col("low")).alias("low"),
        F.when(gap, F.greatest(F.coalesce("high", zero), zero)).otherwise(F.col("high")).alias("high")), "bm25-queries")
    short = facts.where(F.col("gap") & (F.col("above") < n))
    found = best.select("q", "id", "s")
    if not short.isEmpty():
        found = found.unionByName(_first_others(index, short, best, terms, n, k1, b).withColumn("s", F.lit(0.0)))
    found = found.join(facts, "q").withColumn("norm", F.when(F.col("high") > F.col("low"), (F.col("s") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0))
    out = top_n(found, ["query_id"], [F.desc("norm"), F.asc("id")], n)
    return out.select("query_id", "rank", "id", F.col("s").alias("score"), (F.lit(1.0) - F.col("norm")).alias("distance"))
