"""Derived tables every plan starts from, with their DuckDB twins.

Fixture mapping: a comment is a ``documents`` row (``video_id = source``,
``comment_id = doc_id``, ``comment_text = text``); its embedding and topic
come from ``embeddings`` (``vec_id = doc_id``, ``topic_id = label``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.predicates import doc_pred_keys
from ..operators import sentiment as S
from ..operators.entities import extract_entities
from ..operators import cells as CE
from ..operators import index as IX
from ..operators import postings as PO
from ..operators.index import hashed_counts, sql_spot_counts, sql_token_spots, sql_unit_vector
from ..session import constant_table, kept
from ..sources.tables import read_table
from .fixtures import ENTITY_PATTERNS, EVAL_QUERIES, LEXICON_A


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw comment table (reference ingest schema) over ``documents``."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id"),
        F.col("source").alias("video_id"),
        F.col("doc_id").cast("string").alias("comment_id"),
        F.lit(None).cast("string").alias("author"),
        F.col("text").alias("comment_text"),
        F.lit(None).cast("long").alias("likes"),
        F.lit(None).cast("timestamp").alias("published_at"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 -> F1 -> P1: fill NULL text, clean, drop rows with blank clean text."""
    return T.with_clean_text(comments(spark, sf_dir).withColumn("comment_text", T.fill_text("comment_text")))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned comments + lexicon sentiment (X5) + pattern entities (X7)."""
    c = cleaned(spark, sf_dir)
    c = S.score_sentiment(c, "clean_text", LEXICON_A)
    return c.withColumn("entities", extract_entities(F.col("clean_text"), ENTITY_PATTERNS))


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index corpus: every enriched comment.

    ``id = comment_<video_id>_<comment_id>``; ``document`` is the clean text;
    ``pred_keys`` lists the router filter keys each row satisfies.  A comment
    without an embedding gets the hashing encoder's, one without a topic gets -1.
    """
    e = enriched(spark, sf_dir)
    v = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("topic_id"))
    j = e.join(v, "doc_id", "left")
    # Only comments without a vector are encoded.
    j = j.withColumns({"embedding": F.coalesce("embedding", hashed_counts(F.when(F.col("embedding").isNull(), F.col("clean_text")))), "topic_id": F.coalesce("topic_id", F.lit(-1))})
    return j.select(
        F.concat(F.lit("comment_"), "video_id", F.lit("_"), "comment_id").alias("id"),
        "doc_id", "video_id", "comment_id",
        F.col("clean_text").alias("document"),
        "sentiment_polarity", "sentiment_subjectivity", "entities", "topic_id", "embedding",
        doc_pred_keys(F.col("sentiment_polarity"), F.col("topic_id")).alias("pred_keys"),
    )


def _inputs(sf_dir: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("documents", "embeddings")]


def to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`index_rows` as the index builder takes them."""
    return index_rows(spark, sf_dir).withColumnRenamed("document", "clean_text").drop("pred_keys")


def open_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index of every comment, with the router filter keys that each row satisfies.

    It is built once while the tables stay as they are; searches and filters open it."""
    path = kept(spark, "index", _inputs(sf_dir), lambda folder: IX.build_index(spark, to_index(spark, sf_dir), folder + "/rows"))
    rows = IX.read_index(spark, path + "/rows")
    return rows.withColumn("pred_keys", doc_pred_keys(F.col("sentiment_polarity"), F.col("topic_id")))


def open_postings(spark: SparkSession, sf_dir: str) -> PO.Postings:
    """The stored postings of the index's documents, likewise."""
    path = kept(spark, "postings", _inputs(sf_dir), lambda folder: PO.build(open_index(spark, sf_dir), folder + "/bm25"))
    return PO.opened(spark, path + "/bm25")


def open_cells(spark: SparkSession, sf_dir: str) -> CE.Cells:
    """The stored cells of the index's vectors, likewise."""
    path = kept(spark, "cells", _inputs(sf_dir), lambda folder: CE.build(
        open_index(spark, sf_dir).drop("document", "entities", "entity_list"), folder + "/cells"))
    return CE.opened(spark, path + "/cells")


def embedded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the comments that came with a vector."""
    v = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return cleaned(spark, sf_dir).join(v, "doc_id", "left_semi").select(
        F.concat(F.lit("comment_"), "video_id", F.lit("_"), "comment_id").alias("id"))


def lexical_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaned comments (``id``, ``document``)."""
    c = cleaned(spark, sf_dir)
    return c.select(F.concat(F.lit("comment_"), "video_id", F.lit("_"), "comment_id").alias("id"),
                    F.col("clean_text").alias("document"))


def eval_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation query table; dense query vectors come from ``embeddings``."""
    rows = [(qid, q, kws, topics, vec) for qid, q, kws, topics, vec in EVAL_QUERIES]
    qs = constant_table(
        spark, rows, "query_id string, query string, expected_keywords array<string>, "
                     "expected_topic_ids array<int>, vec_id long")
    v = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("qvec"))
    return qs.join(v, "vec_id", "left").drop("vec_id")


# ----------------------------------------------------------------- SQL twins
def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_eval_queries_values() -> str:
    rows = []
    for qid, q, kws, topics, vec in EVAL_QUERIES:
        kw = "[" + ", ".join(_sq(k) for k in kws) + "]::VARCHAR[]"
        tp = "[" + ", ".join(str(t) for t in topics) + "]::INTEGER[]"
        rows.append(f"({_sq(qid)}, {_sq(q)}, {kw}, {tp}, {vec})")
    return "(VALUES " + ", ".join(rows) + ") AS t(query_id, query, expected_keywords, expected_topic_ids, vec_id)"


def sql_ctes(*extra: str) -> str:
    """``WITH`` clause defining comments, cleaned, enriched, idx, lexcorp,
    evalq; ``extra`` CTE bodies (``name AS (...)``) are appended."""
    toks = T.sql_ml_tokens("clean_text")
    base = [
        "comments AS (SELECT doc_id, source AS video_id, CAST(doc_id AS VARCHAR) AS comment_id, "
        "CAST(NULL AS VARCHAR) AS author, text AS comment_text FROM documents)",
        f"cleaned0 AS (SELECT doc_id, video_id, comment_id, author, {T.sql_fill_text('comment_text')} AS comment_text FROM comments)",
        f"cleaned AS (SELECT * FROM (SELECT *, {T.sql_clean_text('comment_text')} AS clean_text FROM cleaned0) WHERE clean_text <> '')",
        f"enriched0 AS (SELECT *, {toks} AS mltoks FROM cleaned)",
        "enriched AS (SELECT doc_id, video_id, comment_id, author, comment_text, clean_text, "
        f"{S.sql_polarity('mltoks', LEXICON_A)} AS sentiment_polarity, "
        f"{S.sql_subjectivity('mltoks', LEXICON_A)} AS sentiment_subjectivity FROM enriched0)",
        f"idx0 AS (SELECT e.*, coalesce(v.label, -1) AS topic_id, v.embedding AS given, CASE WHEN v.embedding IS NULL THEN {sql_token_spots(toks)} "
        "ELSE [] END AS spots FROM enriched e LEFT JOIN embeddings v ON v.vec_id = e.doc_id)",
        f"idx1 AS (SELECT *, {sql_spot_counts('spots')} AS counts FROM idx0)",
        "idx AS (SELECT 'comment_' || video_id || '_' || comment_id AS id, doc_id, video_id, comment_id, "
        "clean_text AS document, sentiment_polarity, sentiment_subjectivity, topic_id, "
        f"coalesce(given, {sql_unit_vector('counts')}) AS embedding, list_filter(['all', CASE WHEN sentiment_polarity < -0.1 THEN 'neg' "
        "WHEN sentiment_polarity > 0.1 THEN 'pos' END, 'topic:' || CAST(topic_id AS VARCHAR)], lambda k: k IS NOT NULL) AS pred_keys "
        "FROM idx1)",
        "embedded AS (SELECT 'comment_' || video_id || '_' || comment_id AS id FROM cleaned WHERE doc_id IN (SELECT vec_id FROM embeddings))",
        "lexcorp AS (SELECT 'comment_' || video_id || '_' || comment_id AS id, clean_text AS document FROM cleaned)",
        f"evalq AS (SELECT q.query_id, q.query, q.expected_keywords, q.expected_topic_ids, v.embedding AS qvec "
        f"FROM {sql_eval_queries_values()} LEFT JOIN embeddings v ON v.vec_id = q.vec_id)".replace(
            "AS t(query_id", "AS q(query_id"),
    ]
    return "WITH " + ",\n".join(base + list(extra))
