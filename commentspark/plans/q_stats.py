"""Corpus statistics report (X19): A1-A6, A15, A21, A22, W5, W6, F6, F20, F25."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ranking import top_n
from ..functions.scalars import excerpt, sql_excerpt
from ..operators.entities import legacy_entity_string, parse_legacy_entities
from ..operators.sentiment import sentiment_label, sql_sentiment_label
from ..functions import text as T
from ..operators import sketches as SK
from ..session import fresh_path
from . import corpus as C
from .catalog import register, sql_typed, typed
from .fixtures import ENTITY_PATTERNS


def _sql(ctes, final):
    return C.sql_ctes(*ctes) + "\n" + final


def labelled(spark, sf):
    e = C.enriched(spark, sf)
    return e.withColumn("sentiment_label", sentiment_label(F.col("sentiment_polarity")))


LAB = f"lab AS (SELECT *, {sql_sentiment_label('sentiment_polarity')} AS sentiment_label FROM enriched)"

S_A1 = [("video_id", "string"), ("n_comments", "bigint")]


@register("a1_rows_per_video", lambda: _sql([],
    "SELECT CAST(video_id AS VARCHAR) AS video_id, CAST(count(*) AS BIGINT) AS n_comments FROM cleaned "
    "WHERE video_id IS NOT NULL GROUP BY video_id"))
def a1_rows_per_video(spark, sf):
    """Comments per video (NULL keys dropped), descending."""
    c = C.cleaned(spark, sf).where(F.col("video_id").isNotNull())
    out = c.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_comments"))
    return typed(out.orderBy(F.desc("n_comments"), "video_id"), S_A1)


S_A2 = [("total_comments", "bigint"), ("unique_videos", "bigint"), ("avg_len", "double"),
        ("median_len", "double")]


@register("a2_a3_overview", lambda: _sql([],
    "SELECT CAST(count(*) AS BIGINT) AS total_comments, CAST(count(DISTINCT video_id) AS BIGINT) AS unique_videos, "
    "round(avg(length(clean_text)), 6) AS avg_len, round(CAST(median(length(clean_text)) AS DOUBLE), 6) AS median_len FROM cleaned"))
def a2_a3_overview(spark, sf):
    """Row count, distinct videos, mean and exact (interpolated) median length (sketches: ``a2_term_sketches``)."""
    c = C.cleaned(spark, sf)
    out = c.agg(F.count(F.lit(1)).alias("total_comments"), F.count_distinct("video_id").alias("unique_videos"),
                F.avg(F.length("clean_text")).alias("avg_len"), F.median(F.length("clean_text")).alias("median_len"))
    return typed(out, S_A2)


S_A4 = [("sentiment_label", "string"), ("n", "bigint"), ("percent", "double")]


@register("a4_label_distribution", lambda: _sql([LAB,
    "g AS (SELECT sentiment_label, count(*) AS n FROM lab GROUP BY sentiment_label)"],
    "SELECT CAST(sentiment_label AS VARCHAR) AS sentiment_label, CAST(n AS BIGINT) AS n, "
    "round_even(n * 100.0 / sum(n) OVER (), 1) AS percent FROM g"))
def a4_label_distribution(spark, sf):
    """Sentiment label counts and percent of total, half-even to 1 decimal.

    The percent-of-total window runs over the three grouped rows only."""
    g = labelled(spark, sf).groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    total = F.sum("n").over(Window.partitionBy())
    out = g.select("sentiment_label", "n", F.bround(F.col("n") * 100.0 / total, 1).alias("percent"))
    return typed(out, S_A4)


S_A5 = [("mean_polarity", "double"), ("std_polarity", "double")]


@register("a5_polarity_moments", lambda: _sql([],
    "SELECT round(avg(sentiment_polarity), 6) AS mean_polarity, round(stddev_samp(sentiment_polarity), 6) AS std_polarity FROM enriched"))
def a5_polarity_moments(spark, sf):
    """Global mean and sample standard deviation of polarity."""
    e = C.enriched(spark, sf)
    return typed(e.agg(F.avg("sentiment_polarity").alias("mean_polarity"),
                       F.stddev_samp("sentiment_polarity").alias("std_polarity")), S_A5)


S_A6 = [("video_id", "string"), ("count", "bigint"), ("mean", "double"), ("std", "double")]


@register("a6_per_video_sentiment", lambda: _sql([],
    "SELECT CAST(video_id AS VARCHAR) AS video_id, CAST(count(sentiment_polarity) AS BIGINT) AS count, "
    "round_even(avg(sentiment_polarity), 3) AS mean, round_even(stddev_samp(sentiment_polarity), 3) AS std "
    "FROM enriched GROUP BY video_id"))
def a6_per_video_sentiment(spark, sf):
    """Per-video count, mean, sample std of polarity, half-even to 3 decimals."""
    e = C.enriched(spark, sf)
    out = e.groupBy("video_id").agg(F.count("sentiment_polarity").alias("count"),
                                    F.bround(F.avg("sentiment_polarity"), 3).alias("mean"),
                                    F.bround(F.stddev_samp("sentiment_polarity"), 3).alias("std"))
    return typed(out, S_A6)


S_A22 = [("video_id", "string"), ("sentiment_label", "string"), ("n", "bigint"), ("mean_polarity", "double")]


@register("a22_video_label_sentiment", lambda: _sql([LAB],
    "SELECT CAST(video_id AS VARCHAR) AS video_id, sentiment_label, CAST(count(*) AS BIGINT) AS n, "
    "round(avg(sentiment_polarity), 6) AS mean_polarity FROM lab GROUP BY video_id, sentiment_label"))
def a22_video_label_sentiment(spark, sf):
    """Mean polarity and count per (video, sentiment label)."""
    out = labelled(spark, sf).groupBy("video_id", "sentiment_label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("sentiment_polarity").alias("mean_polarity"))
    return typed(out, S_A22)


S_A15 = [("video_id", "string")]


@register("a15_distinct_videos", lambda: _sql([],
    "SELECT DISTINCT CAST(video_id AS VARCHAR) AS video_id FROM idx WHERE video_id IS NOT NULL AND video_id <> ''"))
def a15_distinct_videos(spark, sf):
    """Sorted distinct video ids from the index metadata, falsy dropped."""
    i = C.open_index(spark, sf).select("video_id")
    out = i.where(F.col("video_id").isNotNull() & (F.col("video_id") != "")).distinct().orderBy("video_id")
    return typed(out, S_A15)


def _sql_entity_strings():
    from ..operators.entities import sql_entity_rows
    ents = sql_entity_rows("clean_text", ENTITY_PATTERNS)
    return [
        f"ee0 AS (SELECT doc_id, {ents} AS l FROM cleaned)",
        "ee1 AS (SELECT doc_id, list_filter(l, lambda x, i: NOT list_contains(l[1:i-1], x)) AS l FROM ee0)",
        "ees AS (SELECT doc_id, array_to_string(list_transform(l, lambda e: e.text || ' (' || e.label || ')'), ', ') AS s FROM ee1)",
        "ment AS (SELECT regexp_replace(unnest(string_split(s, ', ')), ' \\((ORG|PERSON|PRODUCT|GPE)\\)$', '') AS entity FROM ees)",
    ]


def _mentions(spark, sf):
    e = C.enriched(spark, sf).select(legacy_entity_string(F.col("entities")).alias("s"))
    return e.select(F.explode(parse_legacy_entities(F.col("s"))).alias("entity"))


S_A21 = [("entity", "string"), ("n", "bigint"), ("rank", "bigint")]


@register("a21_top_entities", lambda: _sql(_sql_entity_strings(),
    "SELECT * FROM (SELECT CAST(entity AS VARCHAR) AS entity, CAST(count(*) AS BIGINT) AS n, "
    "CAST(row_number() OVER (ORDER BY count(*) DESC, entity ASC) AS BIGINT) AS rank FROM ment GROUP BY entity) WHERE rank <= 15"))
def a21_top_entities(spark, sf):
    """Top-15 entity strings parsed from the legacy "X (LABEL)" form (F20).
    An empty entity list parses to one empty string, as in the reference."""
    g = _mentions(spark, sf).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    top = g.orderBy(F.desc("n"), F.asc("entity")).limit(15)
    from pyspark.sql import Window
    out = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("entity"))))
    return typed(out, S_A21)


S_A21B = [("total_mentions", "bigint"), ("unique_mentions", "bigint")]


@register("a21_entity_totals", lambda: _sql(_sql_entity_strings(),
    "SELECT CAST(count(*) AS BIGINT) AS total_mentions, CAST(count(DISTINCT entity) AS BIGINT) AS unique_mentions FROM ment"))
def a21_entity_totals(spark, sf):
    """Total and unique entity mentions."""
    m = _mentions(spark, sf)
    return typed(m.agg(F.count(F.lit(1)).alias("total_mentions"),
                       F.count_distinct("entity").alias("unique_mentions")), S_A21B)


S_SK = [("video_id", "string"), ("n_terms", "bigint"), ("unique_terms", "bigint"), ("estimate_holds", "bigint")]


def _sketch_sql():
    return _sql([f"tk AS (SELECT video_id, unnest({T.sql_ml_tokens('clean_text')}) AS term FROM cleaned)"],
                "SELECT CAST(coalesce(video_id, '(all)') AS VARCHAR) AS video_id, CAST(count(*) AS BIGINT) AS n_terms, "
                "CAST(count(DISTINCT term) AS BIGINT) AS unique_terms, CAST(1 AS BIGINT) AS estimate_holds "
                "FROM tk GROUP BY GROUPING SETS ((video_id), ())")


@register("a2_term_sketches", _sketch_sql)
def a2_term_sketches(spark, sf):
    """Distinct terms per video and of all by stored sketches, written in two loads and merged without a rescan, beside
    the exact count: the estimate holds if it is within three standard errors of it."""
    terms = C.cleaned(spark, sf).select("doc_id", F.coalesce("video_id", F.lit("(none)")).alias("video_id"), F.explode(T.ml_tokens("clean_text")).alias("term"))
    path = fresh_path(spark, "term-sketches")
    for load in (0, 1):
        SK.keep(SK.sketched(terms.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == load), ["video_id"], F.col("term")), path)
    stored = SK.kept(spark, path)
    found = SK.merged(stored, ["video_id"]).unionByName(SK.merged(stored, []).withColumn("video_id", F.lit("(all)")))
    pairs = terms.select("video_id", "term").distinct()
    exact = pairs.groupBy("video_id").agg(F.count(F.lit(1)).alias("unique_terms")).unionByName(
        pairs.select(F.lit("(all)").alias("video_id"), "term").distinct().groupBy("video_id").agg(F.count(F.lit(1)).alias("unique_terms")))
    holds = F.abs(F.col("n_distinct") - F.col("unique_terms")) <= F.ceil(F.col("unique_terms") * SK.error_bound())
    out = found.join(exact, "video_id").select("video_id", F.col("n").alias("n_terms"), "unique_terms", holds.cast("long").alias("estimate_holds"))
    return typed(out, S_SK)


S_W5 = [("sentiment_label", "string"), ("rank", "bigint"), ("doc_id", "bigint"), ("polarity", "double"),
        ("excerpt", "string")]


@register("w5_samples_per_class", lambda: _sql([LAB],
    "SELECT * FROM (SELECT sentiment_label, CAST(row_number() OVER (PARTITION BY sentiment_label ORDER BY doc_id) AS BIGINT) AS rank, "
    f"CAST(doc_id AS BIGINT) AS doc_id, round(sentiment_polarity, 6) AS polarity, {sql_excerpt('clean_text', 80)} AS excerpt FROM lab) WHERE rank <= 3"))
def w5_samples_per_class(spark, sf):
    """First three comments per sentiment class (in comment order), with
    80-character excerpts."""
    lab = labelled(spark, sf).select("sentiment_label", "doc_id", F.col("sentiment_polarity").alias("polarity"),
                                     excerpt(F.col("clean_text"), 80).alias("excerpt"))
    return typed(top_n(lab, ["sentiment_label"], [F.asc("doc_id")], 3), S_W5)


S_F6 = [("doc_id", "bigint"), ("sentiment_polarity", "double"), ("sentiment_label", "string")]


@register("f6_sentiment_label", lambda: _sql([LAB],
    f"SELECT {sql_typed(S_F6)} FROM lab"))
def f6_sentiment_label(spark, sf):
    """Label by polarity: > 0.1 positive, < -0.1 negative, else neutral."""
    return typed(labelled(spark, sf), S_F6)


S_X19 = [("total_comments", "bigint"), ("unique_videos", "bigint"), ("avg_len", "double"),
         ("median_len", "double"), ("mean_polarity", "double"), ("std_polarity", "double"),
         ("positive", "bigint"), ("neutral", "bigint"), ("negative", "bigint")]


@register("x19_stats_report", lambda: _sql([LAB],
    "SELECT CAST(count(*) AS BIGINT) AS total_comments, CAST(count(DISTINCT video_id) AS BIGINT) AS unique_videos, "
    "round(avg(length(clean_text)), 6) AS avg_len, round(CAST(median(length(clean_text)) AS DOUBLE), 6) AS median_len, "
    "round(avg(sentiment_polarity), 6) AS mean_polarity, round(stddev_samp(sentiment_polarity), 6) AS std_polarity, "
    "CAST(count_if(sentiment_label = 'positive') AS BIGINT) AS positive, CAST(count_if(sentiment_label = 'neutral') AS BIGINT) AS neutral, "
    "CAST(count_if(sentiment_label = 'negative') AS BIGINT) AS negative FROM lab"))
def x19_stats_report(spark, sf):
    """One-pass corpus overview: counts, lengths, polarity moments, labels."""
    lab = labelled(spark, sf)
    out = lab.agg(F.count(F.lit(1)).alias("total_comments"), F.count_distinct("video_id").alias("unique_videos"),
                  F.avg(F.length("clean_text")).alias("avg_len"), F.median(F.length("clean_text")).alias("median_len"),
                  F.avg("sentiment_polarity").alias("mean_polarity"),
                  F.stddev_samp("sentiment_polarity").alias("std_polarity"),
                  F.count_if(F.col("sentiment_label") == "positive").alias("positive"),
                  F.count_if(F.col("sentiment_label") == "neutral").alias("neutral"),
                  F.count_if(F.col("sentiment_label") == "negative").alias("negative"))
    return typed(out, S_X19)
