"""Scalar-function and projection plans: F1-F5, F8-F10, F17, F19, F21,
F22, F24, P1-P4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.ranking import top_n
from ..functions.scalars import (entities_payload, excerpt, safe_float, safe_int, sanitize_json_list,
                                 sql_excerpt, sql_safe_int_num, sql_safe_int_str, sql_sanitize_json_list,
                                 trailing_int)
from ..operators.entities import extract_entities
from ..sources.tables import read_table
from . import corpus as C
from .catalog import register, sql_typed, typed
from .fixtures import ENTITY_PATTERNS, EVAL_QUERIES


def _sql(ctes, final):
    return C.sql_ctes(*ctes) + "\n" + final


S_CLEAN = [("doc_id", "bigint"), ("clean_text", "string")]


@register("f1_clean_text", lambda: _sql([], f"SELECT {sql_typed(S_CLEAN)} FROM cleaned"))
def f1_clean_text(spark, sf):
    """URL strip, character whitelist, whitespace collapse, strip."""
    return typed(C.cleaned(spark, sf), S_CLEAN)


S_TOK = [("doc_id", "bigint"), ("n_tokens", "bigint"), ("tokens", "string")]


@register("f2_ws_tokens", lambda: _sql(
    [f"t AS (SELECT doc_id, {T.sql_ws_tokens('clean_text')} AS toks FROM cleaned)"],
    "SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, "
    "array_to_string(toks, '|') AS tokens FROM t"))
def f2_ws_tokens(spark, sf):
    """``lower().split()`` tokens of the clean text (BM25 tokenizer)."""
    c = C.cleaned(spark, sf).select("doc_id", T.ws_tokens("clean_text").alias("toks"))
    return typed(c.select("doc_id", F.size("toks").alias("n_tokens"),
                          F.array_join("toks", "|").alias("tokens")), S_TOK)


@register("f3_ml_tokens", lambda: _sql(
    [f"t AS (SELECT doc_id, {T.sql_ml_tokens('clean_text')} AS toks FROM cleaned)"],
    "SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, "
    "array_to_string(toks, '|') AS tokens FROM t"))
def f3_ml_tokens(spark, sf):
    """Vectorizer tokens: lower-case runs of 2+ word characters."""
    c = C.cleaned(spark, sf).select("doc_id", T.ml_tokens("clean_text").alias("toks"))
    return typed(c.select("doc_id", F.size("toks").alias("n_tokens"),
                          F.array_join("toks", "|").alias("tokens")), S_TOK)


@register("f4_stop_words", lambda: _sql(
    [f"t0 AS (SELECT doc_id, {T.sql_ml_tokens('clean_text')} AS m FROM cleaned)",
     f"t AS (SELECT doc_id, {T.sql_remove_stop_words('m')} AS toks FROM t0)"],
    "SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, "
    "array_to_string(toks, '|') AS tokens FROM t"))
def f4_stop_words(spark, sf):
    """Vectorizer tokens with the English stop words removed."""
    c = C.cleaned(spark, sf).select("doc_id", T.remove_stop_words(T.ml_tokens("clean_text")).alias("toks"))
    return typed(c.select("doc_id", F.size("toks").alias("n_tokens"),
                          F.array_join("toks", "|").alias("tokens")), S_TOK)


@register("f5_ngrams", lambda: _sql(
    [f"t0 AS (SELECT doc_id, {T.sql_ml_tokens('clean_text')} AS m FROM cleaned)",
     f"t1 AS (SELECT doc_id, {T.sql_remove_stop_words('m')} AS f FROM t0)",
     f"t AS (SELECT doc_id, {T.sql_uni_and_bigrams('f')} AS toks FROM t1)"],
    "SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, "
    "array_to_string(toks, '|') AS tokens FROM t"))
def f5_ngrams(spark, sf):
    """Uni- and bigrams over the stop-word-filtered token sequence."""
    c = C.cleaned(spark, sf).select("doc_id", T.remove_stop_words(T.ml_tokens("clean_text")).alias("f"))
    c = c.select("doc_id", T.uni_and_bigrams(F.col("f")).alias("toks"))
    return typed(c.select("doc_id", F.size("toks").alias("n_tokens"),
                          F.array_join("toks", "|").alias("tokens")), S_TOK)


S_P1 = [("conv_id", "bigint"), ("turn", "bigint"), ("clean_text", "string")]


@register("p1_drop_blank", lambda: (
    "SELECT " + sql_typed(S_P1) + " FROM (SELECT conv_id, turn, "
    + T.sql_clean_text("coalesce(text, '')") + " AS clean_text FROM conversations) WHERE "
    + T.sql_is_nonblank("clean_text")))
def p1_drop_blank(spark, sf):
    """Drop rows whose (Unicode-stripped) cleaned text is empty."""
    c = read_table(spark, sf, "conversations").select(
        "conv_id", "turn", T.clean_text(T.fill_text("text")).alias("clean_text"))
    return typed(c.where(T.is_nonblank("clean_text")), S_P1)


S_P2 = [("doc_id", "bigint"), ("quality", "bigint"), ("toxic", "bigint")]


@register("p2_dropna_subset",
          "SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(l.quality AS BIGINT) AS quality, "
          "CAST(l.toxic AS BIGINT) AS toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id "
          "WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL")
def p2_dropna_subset(spark, sf):
    """``dropna(subset=[quality, toxic])`` after a left join."""
    d = read_table(spark, sf, "documents").select("doc_id")
    j = d.join(read_table(spark, sf, "labels"), "doc_id", "left")
    return typed(j.dropna(subset=["quality", "toxic"]), S_P2)


S_P3 = [("doc_id", "bigint"), ("video_id", "string"), ("comment_id", "string")]


@register("p3_required_nonblank", lambda: _sql([],
    "SELECT " + sql_typed(S_P3) + " FROM cleaned WHERE " + " AND ".join(
        T.sql_is_nonblank(c) for c in ("video_id", "clean_text", "comment_id"))))
def p3_required_nonblank(spark, sf):
    """Skip rows lacking any of video_id, clean_text, comment_id after strip."""
    c = C.cleaned(spark, sf)
    cond = T.is_nonblank("video_id") & T.is_nonblank("clean_text") & T.is_nonblank("comment_id")
    return typed(c.where(cond), S_P3)


S_P4 = [("doc_id", "bigint"), ("quality_text", "string")]


@register("p4_fill_text",
          "SELECT CAST(d.doc_id AS BIGINT) AS doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS quality_text "
          "FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def p4_fill_text(spark, sf):
    """``fillna('').astype(str)`` on a column with gaps."""
    d = read_table(spark, sf, "documents").select("doc_id")
    j = d.join(read_table(spark, sf, "labels"), "doc_id", "left")
    return typed(j.select("doc_id", T.fill_text("quality").alias("quality_text")), S_P4)


S_F8 = [("event_id", "bigint"), ("props_f", "double"), ("value_f", "double"), ("props_i", "bigint"),
        ("value_i", "bigint"), ("value_str_i", "bigint"), ("user_str_i", "bigint")]


@register("f8_f9_safe_casts", lambda: (
    "SELECT CAST(event_id AS BIGINT) AS event_id, "
    "round(coalesce(TRY_CAST(props AS DOUBLE), 0.0), 6) AS props_f, "
    "round(coalesce(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 0.0), 6) AS value_f, "
    f"CAST({sql_safe_int_str('props')} AS BIGINT) AS props_i, "
    f"CAST({sql_safe_int_num('value')} AS BIGINT) AS value_i, "
    f"CAST({sql_safe_int_str('CAST(value AS VARCHAR)')} AS BIGINT) AS value_str_i, "
    f"CAST({sql_safe_int_str('CAST(user_id AS VARCHAR)')} AS BIGINT) AS user_str_i FROM events"))
def f8_f9_safe_casts(spark, sf):
    """Safe float (default 0.0) and safe int (default -1; '3.0' -> -1, 2.7 -> 2)."""
    e = read_table(spark, sf, "events")
    out = e.select("event_id", safe_float(F.col("props")).alias("props_f"),
                   safe_float(F.col("value").cast("string")).alias("value_f"),
                   safe_int(F.col("props")).alias("props_i"), safe_int(F.col("value")).alias("value_i"),
                   safe_int(F.col("value").cast("string")).alias("value_str_i"),
                   safe_int(F.col("user_id").cast("string")).alias("user_str_i"))
    return typed(out, S_F8)


S_F10 = [("src", "string"), ("row_id", "bigint"), ("entities", "string"), ("truncated", "bigint"),
         ("n_chars", "bigint")]


def _f10_sql():
    from ..operators.entities import sql_entity_rows
    ents = sql_entity_rows("text", ENTITY_PATTERNS)
    return (
        f"WITH e0 AS (SELECT doc_id, {ents} AS l FROM documents), "
        "e1 AS (SELECT doc_id, list_filter(l, lambda x, i: NOT list_contains(l[1:i-1], x)) AS l FROM e0), "
        "raw AS (SELECT 'documents' AS src, doc_id AS row_id, CAST(to_json(l) AS VARCHAR) AS raw FROM e1 "
        "UNION ALL SELECT 'pages', page_id, html FROM pages UNION ALL SELECT 'events', event_id, props FROM events), "
        f"s AS (SELECT src, row_id, {sql_sanitize_json_list('raw')} AS full_json FROM raw) "
        "SELECT src, CAST(row_id AS BIGINT) AS row_id, left(full_json, 800) AS entities, "
        "CAST(length(full_json) > 800 AS BIGINT) AS truncated, CAST(length(full_json) AS BIGINT) AS n_chars FROM s")


@register("f10_sanitize_entities", _f10_sql)
def f10_sanitize_entities(spark, sf):
    """JSON list sanitiser: invalid or non-list -> '[]', compact re-serialise,
    800-character cap with a truncation flag."""
    d = read_table(spark, sf, "documents")
    docs = d.select(F.lit("documents").alias("src"), F.col("doc_id").alias("row_id"),
                    entities_payload(extract_entities(F.col("text"), ENTITY_PATTERNS)).alias("raw"))
    pages = read_table(spark, sf, "pages").select(F.lit("pages").alias("src"), F.col("page_id").alias("row_id"),
                                                  F.col("html").alias("raw"))
    ev = read_table(spark, sf, "events").select(F.lit("events").alias("src"), F.col("event_id").alias("row_id"),
                                                F.col("props").alias("raw"))
    u = docs.unionByName(pages).unionByName(ev)
    full = sanitize_json_list(F.col("raw"))
    out = u.select("src", "row_id", F.substring(full, 1, 800).alias("entities"),
                   (F.length(full) > 800).cast("bigint").alias("truncated"),
                   F.length(full).alias("n_chars"))
    return typed(out, S_F10)


S_F17 = [("doc_id", "bigint"), ("excerpt", "string"), ("prefix200", "string")]


@register("f17_excerpts", lambda: _sql([],
    f"SELECT CAST(doc_id AS BIGINT) AS doc_id, {sql_excerpt('clean_text', 80)} AS excerpt, "
    "left(clean_text, 200) AS prefix200 FROM cleaned"))
def f17_excerpts(spark, sf):
    """80-character excerpt with '...' when longer; 200-character prefix."""
    c = C.cleaned(spark, sf)
    return typed(c.select("doc_id", excerpt(F.col("clean_text"), 80).alias("excerpt"),
                          F.substring("clean_text", 1, 200).alias("prefix200")), S_F17)


S_F19 = [("vec_id", "bigint"), ("topic_label", "string"), ("topic_id", "bigint")]


@register("f19_trailing_int",
          "SELECT CAST(vec_id AS BIGINT) AS vec_id, 'Topic ' || CAST(label AS VARCHAR) AS topic_label, "
          "CAST(string_split('Topic ' || CAST(label AS VARCHAR), ' ')[-1] AS BIGINT) AS topic_id FROM embeddings")
def f19_trailing_int(spark, sf):
    """Trailing integer of a label such as 'Topic 7'."""
    e = read_table(spark, sf, "embeddings").select("vec_id", F.concat(F.lit("Topic "), F.col("label").cast("string")).alias("topic_label"))
    return typed(e.select("vec_id", "topic_label", trailing_int(F.col("topic_label")).alias("topic_id")), S_F19)


S_F21 = [("vec_id", "bigint"), ("argmax", "bigint"), ("max_value", "double")]


@register("f21_argmax",
          "SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax, "
          "round(CAST(list_max(embedding) AS DOUBLE), 6) AS max_value FROM embeddings")
def f21_argmax(spark, sf):
    """Index of the first maximum of an array (0-based)."""
    e = read_table(spark, sf, "embeddings")
    return typed(e.select("vec_id", (F.array_position("embedding", F.array_max("embedding")) - 1).alias("argmax"),
                          F.array_max("embedding").alias("max_value")), S_F21)


S_F22 = [("vec_id", "bigint"), ("rank", "bigint"), ("idx", "bigint"), ("weight", "double")]


@register("f22_top_indices",
          "SELECT * FROM (SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY w DESC, i ASC) AS BIGINT) AS rank, "
          "CAST(i AS BIGINT) AS idx, round(CAST(w AS DOUBLE), 6) AS weight FROM "
          "(SELECT vec_id, unnest(embedding) AS w, unnest(range(len(embedding))) AS i FROM embeddings)) WHERE rank <= 10")
def f22_top_indices(spark, sf):
    """Top-10 indices of a weight vector, descending."""
    e = read_table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("idx", "weight"))
    return typed(top_n(e, ["vec_id"], [F.desc("weight"), F.asc("idx")], 10), S_F22)


S_F24 = [("doc_id", "bigint"), ("query_id", "string"), ("has_keyword", "bigint")]


def _f24_sql():
    rows = []
    for qid, _q, kws, _t, _v in EVAL_QUERIES:
        kw = ", ".join("'" + k.lower().replace("'", "''") + "'" for k in kws)
        rows.append(f"('{qid}', [{kw}])")
    return _sql([f"kq AS (SELECT * FROM (VALUES {', '.join(rows)}) AS t(query_id, kws))"],
                "SELECT CAST(c.doc_id AS BIGINT) AS doc_id, kq.query_id, "
                "CAST(len(list_filter(kq.kws, lambda k: contains(lower(c.clean_text), k))) > 0 AS BIGINT) AS has_keyword "
                "FROM cleaned c, kq")


@register("f24_any_keyword", _f24_sql)
def f24_any_keyword(spark, sf):
    """Case-insensitive any-keyword containment, one flag per (doc, query
    keyword set); the keyword sets are attached row-locally as literals."""
    c = C.cleaned(spark, sf).select("doc_id", F.lower("clean_text").alias("low"))
    sets = F.array(*[F.struct(F.lit(qid).alias("query_id"),
                              F.array(*[F.lit(k.lower()) for k in kws]).alias("kws"))
                     for qid, _q, kws, _t, _v in EVAL_QUERIES])
    x = c.select("doc_id", "low", F.inline(sets))
    out = x.select("doc_id", "query_id",
                   F.exists("kws", lambda k: F.col("low").contains(k)).cast("bigint").alias("has_keyword"))
    return typed(out, S_F24)
