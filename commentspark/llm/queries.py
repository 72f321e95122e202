"""The operators as named queries over the driver's tables, whole."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, divergence, embed_dedup, langid, line_dedup, mixing, ngram_join, packing, pii, simhash, spelling, url_filter, warc

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole text, decode the ids, digest both."""
    vocab = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(common.read(spark, sf_dir, "documents"), vocab, public_tokenizers.PATTERN)
    both = bpe.decode(ids.withColumn("coded", F.col("ids")), vocab, public_tokenizers.PATTERN)
    return both.select("doc_id", (F.length("coded") / 4).cast("long").alias("n_tokens"),
                       F.sha2("coded", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document tokenised, cut and packed into sequences of at most 1024 tokens."""
    ids = packing.tokenise(common.read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    pieces = packing.cut(ids).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(common.stored(packing.numbered(pieces), "pieces")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those outside the held-out fold."""
    docs = common.read(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.classify(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors against all, linked at a cosine of 0.9 or more."""
    return embed_dedup.near_duplicates(common.read(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies (five-word n-grams, Jaccard 0.8) and its number of links."""
    found = ngram_join.near_copies(common.read(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template recurs in earlier documents."""
    return line_dedup.dedup(common.read(spark, sf_dir, "documents"), by_support=True).select(
        "doc_id", "text", F.col("n_lines").cast("long"), F.col("n_dropped").cast("long"))


ORACLE["op8_line_dedup"] = line_dedup.dedup_sql()


@query
def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document: base spans, their digest, and all spans."""
    found = pii.candidates(common.read(spark, sf_dir, "documents")).select("doc_id", "candidates")
    found = common.stored(found, "pii-candidates")
    every = found.select("doc_id", pii.spans("candidates", pii.fit(found)).alias("all"))
    of = lambda *kinds: F.filter("all", lambda s: s["kind"].isin(*kinds))
    base = of(*pii.BASE)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return every.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("all")).alias("spans"))


#: Rows whose id is divisible by it are the queries of a search.
SEARCHED = 50


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edit and its likeness to the next; for every 50th id, how many other
    documents lie within the Hamming radius."""
    found = common.stored(simhash.edited_pairs(common.read(spark, sf_dir, "documents")), "simhash")
    asked = F.col("doc_id") % SEARCHED == 0
    found = found.withColumnRenamed("id", "doc_id")
    copies = found.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    pairs = simhash.near(found.filter(asked).select("fingerprint"), found.select("fingerprint"))
    met = pairs.join(copies, "fingerprint").groupBy("query").agg((F.sum("copies") - 1).alias("met"))
    met = found.filter(asked).select("range", "place", "fingerprint").join(met, F.col("fingerprint") == F.col("query")).select("range", "place", F.col("met").alias("n_near"))
    out = found.join(met, ["range", "place"], "left")
    return out.select("doc_id", "n_chars", "edited_sha256", simhash.hexed(F.col("fingerprint")).alias("fingerprint"),
                      simhash.hexed(F.col("edited")).alias("edited_fingerprint"), simhash.likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"),
                      simhash.likeness(F.col("fingerprint"), F.col("next")).alias("near_next"), "n_near")


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back by the index."""
    found = warc.read(warc.write(common.read(spark, sf_dir, "pages")), with_payload=False)
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op6_warc"] = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= {warc.MIN_REVISIT} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)"""


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, or else by the character models."""
    return url_filter.judged(common.read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op10_url_filter"] = url_filter.judged_sql(URL_RULES)


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The term shares of every source against the other sources of its language, and the terms that set it apart."""
    return divergence.audit(common.read(spark, sf_dir, "documents"))


ORACLE["op11_source_divergence"] = divergence.audit_sql()


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every recurring word with its near words' number, its form and its root."""
    return spelling.variants(common.read(spark, sf_dir, "documents"))


@query
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what a mix of the sources by their weights takes of it."""
    return mixing.mix(common.read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
