"""Index plans: X9 (with P10, P3, F8-F10, F13, J1, A20, S5-S7), S1/L1/U1
landed-page ingest, U3, X8, Z1, Z2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.ranking import norm2
from ..functions.scalars import sql_sanitize_json_list
from ..operators import index as IX
from ..operators import postings as PO
from ..operators.entities import sql_entity_rows
from ..operators.retrieval import bm25_search
from ..session import fresh_path
from ..sources.tables import read_table
from ..streaming.index_stream import run_stream_index, stream_dedup
from . import corpus as C
from .catalog import register, typed
from .fixtures import ENTITY_PATTERNS, LEXICON_A
from .sql_retrieval import bm25_ctes

S_X9 = [("id", "string"), ("video_id", "string"), ("comment_id", "string"), ("sentiment_polarity", "double"),
        ("sentiment_subjectivity", "double"), ("entities", "string"), ("n_entities", "bigint"),
        ("entities_truncated", "bigint"), ("topic_id", "bigint")]


def _sql(ctes, final):
    return C.sql_ctes(*ctes) + "\n" + final


def _x9_ctes():
    ents = sql_entity_rows("clean_text", ENTITY_PATTERNS)
    return [
        f"xe0 AS (SELECT doc_id, {ents} AS l FROM cleaned)",
        "xe1 AS (SELECT doc_id, CAST(to_json(list_filter(l, lambda x, i: NOT list_contains(l[1:i-1], x))) AS VARCHAR) AS ej FROM xe0)",
        f"xr AS (SELECT i.*, {sql_sanitize_json_list('xe1.ej')} AS fj FROM idx i JOIN xe1 USING (doc_id))",
    ]


@register("x9_index_build", lambda: _sql(_x9_ctes(),
    "SELECT id, video_id, comment_id, round(sentiment_polarity, 6) AS sentiment_polarity, "
    "round(sentiment_subjectivity, 6) AS sentiment_subjectivity, left(fj, 800) AS entities, "
    "CAST(json_array_length(CAST(fj AS JSON)) AS BIGINT) AS n_entities, CAST(length(fj) > 800 AS BIGINT) AS entities_truncated, CAST(topic_id AS BIGINT) AS topic_id FROM xr"))
def x9_index_build(spark, sf):
    """Build the Parquet index of every comment in a fresh shared folder, then
    scan it back with column pruning; the entity list is whole beside its cut JSON."""
    path = fresh_path(spark, "index")
    rows = C.to_index(spark, sf)
    IX.build_index(spark, rows, path)
    out = IX.read_index(spark, path).withColumn("n_entities", F.size("entity_list"))
    return typed(out.withColumn("entities_truncated", F.col("entities_truncated").cast("long")), S_X9)


@register("s6_reset", lambda: _sql([],
    "SELECT id FROM idx WHERE sentiment_polarity < 0"))
def s6_reset(spark, sf):
    """Reset: a second build with ``reset`` replaces the whole index by its own rows."""
    path = fresh_path(spark, "index")
    rows = C.to_index(spark, sf)
    IX.build_index(spark, rows, path)
    IX.build_index(spark, rows.where(F.col("sentiment_polarity") < 0), path, reset=True)
    return typed(IX.read_index(spark, path), S_J1)


S_A20 = [("run", "bigint"), ("candidates", "bigint"), ("skipped_existing", "bigint"), ("added", "bigint"),
         ("truncated", "bigint")]


@register("a20_incremental_counters", lambda: _sql(_x9_ctes(),
    "SELECT 1 AS run, CAST(count(*) AS BIGINT) AS candidates, CAST(0 AS BIGINT) AS skipped_existing, "
    "CAST(count(*) AS BIGINT) AS added, CAST(count_if(length(fj) > 800) AS BIGINT) AS truncated FROM xr UNION ALL "
    "SELECT 2, count(*), count(*), 0, count_if(length(fj) > 800) FROM xr"))
def a20_incremental_counters(spark, sf):
    """Two runs over the same input: the second skips every id (J1 anti-join)."""
    path = fresh_path(spark, "index")
    rows = C.to_index(spark, sf)
    c1 = IX.build_index(spark, rows, path).withColumn("run", F.lit(1))
    c2 = IX.build_index(spark, rows, path).withColumn("run", F.lit(2))
    return typed(c1.unionByName(c2), S_A20)


S_J1 = [("id", "string")]


@register("j1_left_anti_new_ids", lambda: _sql([],
    "SELECT 'comment_' || video_id || '_' || comment_id AS id FROM cleaned "
    "WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)"))
def j1_left_anti_new_ids(spark, sf):
    """New comments not yet indexed, where the embedded ones are."""
    new = C.cleaned(spark, sf).select(F.concat(F.lit("comment_"), "video_id", F.lit("_"), "comment_id").alias("id"))
    return typed(new.join(C.embedded_ids(spark, sf), "id", "left_anti"), S_J1)


@register("u3_except_all", lambda: _sql([],
    "SELECT 'comment_' || video_id || '_' || comment_id AS id FROM cleaned EXCEPT ALL SELECT id FROM embedded"))
def u3_except_all(spark, sf):
    """Whole-row bag difference of id sets (``exceptAll``)."""
    new = C.cleaned(spark, sf).select(F.concat(F.lit("comment_"), "video_id", F.lit("_"), "comment_id").alias("id"))
    return typed(new.exceptAll(C.embedded_ids(spark, sf)), S_J1)


S_S1 = [("video_id", "string"), ("comment_id", "string"), ("author", "string"), ("comment_text", "string"),
        ("likes", "bigint"), ("published_at", "string")]
TARGET = 150
SQL_S1 = ("SELECT video_id, comment_id, author, comment_text, likes, published_at FROM (SELECT CAST(source AS VARCHAR) AS video_id, "
          "CAST(doc_id AS VARCHAR) AS comment_id, CAST(NULL AS VARCHAR) AS author, {text} AS comment_text, "
          "CAST(n_chars AS BIGINT) AS likes, CAST(NULL AS VARCHAR) AS published_at, doc_id FROM documents) WHERE comment_text <> ''")


def _comments(spark, sf, published=None):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", F.col("source").alias("video_id"), F.col("doc_id").cast("string").alias("comment_id"),
                    F.lit(None).cast("string").alias("author"), F.col("text").alias("comment_text"),
                    F.col("n_chars").alias("likes"), (F.lit(None) if published is None else published).cast("string").alias("published_at"))


def _landed(spark, sf):
    path = fresh_path(spark, "landed")
    IX.land_pages(_comments(spark, sf), path)
    return IX.flatten_pages(IX.read_pages(spark, path))


@register("s1_landed_json_ingest", lambda: SQL_S1.format(text=T.sql_strip_ws("coalesce(text, '')")))
def s1_landed_json_ingest(spark, sf):
    """Comments landed as nested API pages (100 items per page) in the
    shared folder, read back with an explicit schema, flattened, blank text
    dropped."""
    return typed(_landed(spark, sf), S_S1)


@register("l1_row_cap", lambda: SQL_S1.format(text=T.sql_strip_ws("coalesce(text, '')")) + f" ORDER BY video_id, doc_id LIMIT {TARGET}")
def l1_row_cap(spark, sf):
    """The ingest's row cap, in source order (a global top-n)."""
    return typed(IX.cap_rows(_landed(spark, sf), [F.col("video_id"), F.col("comment_id").cast("long")], TARGET), S_S1)


S_X8 = [("doc_id", "bigint"), ("dims", "bigint"), ("norm", "double"), ("first", "double"), ("largest", "double")]


@register("x8_hashing_embeddings", lambda: _sql([
    f"h0 AS (SELECT doc_id, {IX.sql_token_spots(T.sql_ml_tokens('clean_text'))} AS spots FROM cleaned)",
    f"h1 AS (SELECT doc_id, {IX.sql_spot_counts('spots')} AS counts FROM h0)",
    f"h2 AS (SELECT doc_id, {IX.sql_unit_vector('counts')} AS v FROM h1)"],
    "SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(v) AS BIGINT) AS dims, "
    "round(sqrt(list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm, "
    "round(CAST(v[1] AS DOUBLE), 6) AS first, round(CAST(list_max(v) AS DOUBLE), 6) AS largest FROM h2"))
def x8_hashing_embeddings(spark, sf):
    """Native encoder (hashed term counts, L2-normalised) over every comment."""
    c = C.cleaned(spark, sf).select("doc_id", F.col("clean_text").alias("document"))
    e = IX.hashing_encoder(c)
    return typed(e.select("doc_id", F.size("embedding").alias("dims"), norm2(F.col("embedding")).alias("norm"),
                          F.col("embedding")[0].alias("first"), F.array_max("embedding").alias("largest")), S_X8)


S_X8U = [("doc_id", "bigint"), ("chars", "double"), ("es", "double"), ("blanks", "double")]


def letters_model():
    """A deterministic stand-in for a user's model: three counts of each text."""
    def encode(texts):
        return [[float(len(t)), float(t.count("e")), float(t.count(" "))] for t in texts]
    return encode


@register("x8_user_encoder", lambda: _sql([],
    "SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(length(clean_text) AS DOUBLE) AS chars, CAST(length(clean_text) - length(replace(clean_text, 'e', '')) AS DOUBLE) AS es, "
    "CAST(length(clean_text) - length(replace(clean_text, ' ', '')) AS DOUBLE) AS blanks FROM cleaned"))
def x8_user_encoder(spark, sf):
    """A user's model over every comment: made once per worker, called with 64 texts at a time."""
    e = IX.pandas_encoder(C.cleaned(spark, sf).select("doc_id", F.col("clean_text").alias("document")), letters_model)
    return typed(e.select("doc_id", *(F.col("embedding")[i].alias(c) for i, (c, _) in enumerate(S_X8U[1:]))), S_X8U)


@register("z1_stream_incremental_index", lambda: _sql([],
    "SELECT CAST('comment_' || video_id || '_' || comment_id AS VARCHAR) AS id, CAST(video_id AS VARCHAR) AS video_id, comment_id FROM cleaned"))
def z1_stream_incremental_index(spark, sf):
    """Structured Streaming: landed pages -> availableNow trigger ->
    foreachBatch incremental index append (twice: the replay adds nothing)."""
    base = fresh_path(spark, "stream")
    IX.land_pages(_comments(spark, sf), base + "/landing")
    for _ in range(2):
        run_stream_index(spark, base + "/landing", base + "/index", base + "/checkpoint", LEXICON_A, ENTITY_PATTERNS)
    return typed(IX.read_index(spark, base + "/index"), [("id", "string"), ("video_id", "string"), ("comment_id", "string")])


@register("z1_stream_bm25", lambda: _sql(bm25_ctes("b", "idx", "evalq", 10),
    "SELECT query_id, CAST(rank AS BIGINT) AS rank, CAST(id AS VARCHAR) AS id, round(score, 6) AS score, round(distance, 6) AS distance FROM b_top"))
def z1_stream_bm25(spark, sf):
    """BM25 top-10 on postings that the stream kept up over two landings, the second holding all comments again."""
    base = fresh_path(spark, "stream")
    rows = _comments(spark, sf)
    run = lambda: run_stream_index(spark, base + "/landing/*", base + "/index", base + "/checkpoint", LEXICON_A, ENTITY_PATTERNS, base + "/bm25")
    IX.land_pages(rows.where("doc_id % 2 = 0"), base + "/landing/a")
    run()
    IX.land_pages(rows, base + "/landing/b")
    run()
    found = bm25_search(None, C.eval_queries(spark, sf), 10, index=PO.opened(spark, base + "/bm25"))
    return typed(found, [("query_id", "string"), ("rank", "bigint"), ("id", "string"), ("score", "double"), ("distance", "double")])


@register("z2_stream_dedup", "SELECT CAST(doc_id AS VARCHAR) AS comment_id, CAST(source AS VARCHAR) AS video_id FROM documents "
          "WHERE trim(coalesce(text, '')) <> ''")
def z2_stream_dedup(spark, sf):
    """Structured Streaming de-duplication by comment id within a watermark
    over pages landed twice (equals the batch dropDuplicates)."""
    base = fresh_path(spark, "dedup")
    when = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    for part in ("a", "b"):
        IX.land_pages(_comments(spark, sf, when), f"{base}/landing/{part}")
    out = stream_dedup(spark, base + "/landing/*", base + "/out", base + "/checkpoint", watermark="400 days")
    return typed(out, [("comment_id", "string"), ("video_id", "string")])
