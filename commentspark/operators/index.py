"""Incremental Parquet index (X9, J1, A20, S5-S7), landed-page ingest (S1,
L1, U1) and encoders (X8).

The vector store is a bucketed Parquet table (:mod:`commentspark.sources.bucketed`): buckets by
the hash of the id, so new rows meet the ids already there without a shuffle of the
index; folders by ``video_bucket`` and files sorted by topic and polarity, so filters prune
folders and row groups.  Re-runs skip the ids already present.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..functions.predicates import compile_where
from ..functions.scalars import ENTITY_JSON_CAP, safe_float, safe_int, sanitize_json_list
from ..session import workers_see_package
from ..sources import bucketed

REQUIRED = ["video_id", "comment_id", "clean_text"]
ENTITY_LIST = "array<struct<text:string,label:string>>"
OPTIONAL = {"sentiment_polarity": "0.0", "sentiment_subjectivity": "0.0", "entities": "'[]'",
            "topic_id": "-1"}

INDEX_SCHEMA = ("id string, document string, video_id string, comment_id string, sentiment_polarity double, "
                f"sentiment_subjectivity double, entities string, entity_list {ENTITY_LIST}, "
                "entities_truncated boolean, topic_id int, embedding array<float>")

#: Folders that videos are dealt to.
VIDEO_BUCKETS = 16


def video_bucket(video_id: Column) -> Column:
    return F.pmod(F.xxhash64(video_id), F.lit(VIDEO_BUCKETS)).cast("int")


def index_layout(buckets: int) -> bucketed.Layout:
    return bucketed.Layout(INDEX_SCHEMA + ", video_bucket int", ("id",), buckets, ("video_bucket",), ("topic_id", "sentiment_polarity"))


PAGE_SCHEMA = T.StructType([
    T.StructField("nextPageToken", T.StringType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("snippet", T.StructType([
            T.StructField("videoId", T.StringType()),
            T.StructField("topLevelComment", T.StructType([
                T.StructField("snippet", T.StructType([
                    T.StructField("textDisplay", T.StringType()),
                    T.StructField("authorDisplayName", T.StringType()),
                    T.StructField("likeCount", T.LongType()),
                    T.StructField("publishedAt", T.StringType()),
                ]))]))]))]))),
])


PAGE_BUCKETS = 16


# P10 ----------------------------------------------------------------------------
def conform(df: DataFrame, required: list[str] = REQUIRED, optional: dict[str, str] = OPTIONAL) -> DataFrame:
    """Missing required column -> error; missing optional -> default literal.
    Required columns come first, then optional ones, then the others as they were."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    for c, default in optional.items():
        if c not in df.columns:
            df = df.withColumn(c, F.expr(default))
    known = [*required, *optional]
    return df.select(*known, *[c for c in df.columns if c not in known])


# S1 / L1 / U1 ----------------------------------------------------------------------
def flatten_pages(pages: DataFrame) -> DataFrame:
    """Landed API pages -> raw comment rows; missing keys -> NULL, blank text dropped."""
    items = pages.select(F.input_file_name().alias("_file"), F.posexplode("items").alias("_seq", "it"))
    s = F.col("it.snippet.topLevelComment.snippet")
    rows = items.select(
        F.col("it.snippet.videoId").alias("video_id"), F.col("it.id").alias("comment_id"),
        s["authorDisplayName"].alias("author"), TX.strip_ws(F.coalesce(s["textDisplay"], F.lit(""))).alias("comment_text"),
        s["likeCount"].alias("likes"), s["publishedAt"].alias("published_at"), "_file", "_seq")
    return rows.where(F.col("comment_text") != "")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).json(path)


def cap_rows(rows: DataFrame, order_cols: list, target: int) -> DataFrame:
    """L1: global row cap in source order (a global top-n)."""
    return rows.orderBy(*order_cols).limit(target)


def land_pages(comments: DataFrame, path: str, page_size: int = 100) -> None:
    """Write comments as API-shaped JSON pages (``page_size`` items each,
    per video): the landed input of :func:`read_pages`.  A page is a
    bounded group (``page_size`` rows); a video's comments are paged within
    buckets of their id, so a video with a third of all comments is still
    paged by many tasks."""
    from pyspark.sql import Window
    c = comments.withColumn("_bucket", F.pmod(F.xxhash64("comment_id"), F.lit(PAGE_BUCKETS)))
    w = Window.partitionBy("video_id", "_bucket").orderBy("doc_id")
    c = c.withColumn("_page", F.floor((F.row_number().over(w) - 1) / page_size))
    item = F.struct(
        F.col("comment_id").alias("id"),
        F.struct(F.col("video_id").alias("videoId"),
                 F.struct(F.struct(F.col("comment_text").alias("textDisplay"), F.col("author").alias("authorDisplayName"),
                                   F.col("likes").alias("likeCount"), F.col("published_at").alias("publishedAt"))
                          .alias("snippet")).alias("topLevelComment")).alias("snippet"))
    pages = c.groupBy("video_id", "_bucket", "_page").agg(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("it")))).alias("l"))
    pages = pages.select(F.lit(None).cast("string").alias("nextPageToken"),
                         F.transform("l", lambda x: x["it"]).alias("items"))
    pages.write.mode("overwrite").json(path)


# X9 ----------------------------------------------------------------------------
def prepare_index_rows(df: DataFrame) -> DataFrame:
    """Conform, drop rows lacking required fields, build ids and sanitised
    metadata (keywords are not carried into the index).  ``entities`` is the
    JSON string cut at its cap, ``entity_list`` the whole list."""
    d = conform(df)
    ok = TX.is_nonblank("video_id") & TX.is_nonblank("clean_text") & TX.is_nonblank("comment_id")
    d = d.where(ok)
    kind = dict(d.dtypes).get("entities")
    if kind == ENTITY_LIST:  # a list already: written as JSON once, parsed never
        entity_list = F.coalesce("entities", F.array().cast(ENTITY_LIST))
        full = F.to_json(entity_list)
    else:
        full = sanitize_json_list(F.col("entities") if kind == "string" else F.to_json("entities"))
        entity_list = F.from_json(full, ENTITY_LIST)
    return d.select(
        F.concat(F.lit("comment_"), F.trim("video_id"), F.lit("_"), F.trim("comment_id")).alias("id"),
        TX.strip_ws("clean_text").alias("document"),
        F.trim("video_id").alias("video_id"), F.trim("comment_id").alias("comment_id"),
        safe_float(F.col("sentiment_polarity").cast("string")).alias("sentiment_polarity"),
        safe_float(F.col("sentiment_subjectivity").cast("string")).alias("sentiment_subjectivity"),
        F.substring(full, 1, ENTITY_JSON_CAP).alias("entities"), entity_list.alias("entity_list"),
        (F.length(full) > ENTITY_JSON_CAP).alias("entities_truncated"),
        safe_int(F.col("topic_id")).cast("int").alias("topic_id"),
        *[c for c in ("embedding",) if c in d.columns])


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    """The index table; empty where none is written yet.  Any other failure to read is an error."""
    if not bucketed.exists(spark, index_path):
        return spark.createDataFrame([], INDEX_SCHEMA + ", video_bucket int")
    return bucketed.open_table(spark, index_path)


def existing_ids(spark: SparkSession, index_path: str) -> DataFrame:
    """S7: ids only (column pruning)."""
    return read_index(spark, index_path).select("id")


def in_videos(videos: list[str]) -> Column:
    """The videos' rows, with the folders they can lie in named too: the scan lists no other."""
    return F.col("video_id").isin(*videos) & F.col("video_bucket").isin(*(video_bucket(F.lit(v)) for v in videos))


def filtered(index: DataFrame, where: dict[str, Any] | None) -> DataFrame:
    """P5/P6 on the stored index: the conditions reach the scan, and videos asked for by name prune its folders."""
    named = (where or {}).get("video_id")
    if named is not None and not isinstance(named, dict) and "video_bucket" in index.columns:
        index = index.where(in_videos([named] if isinstance(named, str) else list(named)))
    return index.where(compile_where(where))


def build_index(spark: SparkSession, rows: DataFrame, index_path: str, reset: bool = False, buckets: int | None = None) -> DataFrame:
    """X9: append rows whose id is not yet indexed; returns one counter row
    ``candidates, skipped_existing, added, truncated`` (A20).

    Of several rows with one id the first in the order of a hash of all their columns is
    indexed; the others count as skipped.  ``reset`` starts from an empty
    index (S6).  ``buckets`` counts for a new index (:func:`bucketed.default_buckets` otherwise).

    One job reads the input once: rows are shuffled to the index's buckets, meet the ids there, and
    are counted in the tasks that write them (``observe``), whose counts Spark takes once however often a task runs."""
    if reset or not bucketed.exists(spark, index_path):
        bucketed.create(spark, index_path, index_layout(buckets or bucketed.default_buckets(spark)))
    prepared = prepare_index_rows(rows)
    if "embedding" not in prepared.columns:
        prepared = prepared.withColumn("embedding", F.lit(None))
    prepared = prepared.withColumns({"embedding": F.col("embedding").cast("array<float>"), "video_bucket": video_bucket(F.col("video_id"))})
    dealt = bucketed.dealt(prepared, bucketed.layout_of(spark, index_path))
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64(*prepared.columns), "document")) == 1
    have = bucketed.open_table(spark, index_path).select("id", F.lit(True).alias("_have"))
    flagged = dealt.withColumn("_first", first).join(have, "id", "left").withColumn("_new", F.col("_first") & F.col("_have").isNull())
    counts = Observation()
    flagged = flagged.observe(counts, F.count(F.lit(1)).alias("candidates"), F.count_if("_new").alias("added"), F.count_if("entities_truncated").alias("truncated"))
    bucketed.append(flagged.where("_new"), index_path)
    n = counts.get
    return spark.createDataFrame([(n["candidates"], n["candidates"] - n["added"], n["added"], n["truncated"])],
                                 "candidates long, skipped_existing long, added long, truncated long")


# X8 ----------------------------------------------------------------------------
HEX = "0123456789abcdef"


#: Numbers of the vector: a token falls on one of them by the first six bits of its MD5.
SPOTS = 64


def hashed_counts(text: Column) -> Column:
    """Unit vector of the vectorizer tokens' counts in 64 buckets (six bits of the token's MD5), as
    ``array<float>``; a text without tokens is the zero vector, a null text has none.  A task hashes each different token of a batch
    once, and sends back the vectors only."""
    import hashlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    spots = SPOTS

    def vectors(tokens: pa.Array) -> pa.Array:
        known = ~tokens.is_null().to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        found = tokens.flatten().dictionary_encode()
        spot = np.fromiter((hashlib.md5(t.encode(), usedforsecurity=False).digest()[0] >> 2 for t in found.dictionary.to_pylist()), np.int64, len(found.dictionary))
        at = np.repeat(np.arange(len(sizes)), sizes) * spots + (spot[found.indices.to_numpy()] if len(found) else 0)
        counts = np.bincount(at, minlength=len(sizes) * spots).astype(float).reshape(-1, spots)[known]
        norm = np.sqrt((counts * counts).sum(axis=1))  # whole numbers, exact in any order
        values = (counts / np.where(norm > 0, norm, 1.0)[:, None]).astype(np.float32)
        ends = pa.array(np.concatenate([[0], np.cumsum(known) * spots]).astype(np.int32))
        return pa.ListArray.from_arrays(ends, pa.array(values.ravel()), mask=pa.array(~known))

    vectors.__annotations__ = {"tokens": pa.Array, "return": pa.Array}
    return F.arrow_udf(vectors, T.ArrayType(T.FloatType()))(TX.ml_tokens(text))


def hashing_encoder(df: DataFrame, text_col: str = "document", into: str = "embedding") -> DataFrame:
    """Native encoder: :func:`hashed_counts` of each row's text (null: empty)."""
    return df.withColumn(into, hashed_counts(TX.fill_text(text_col)))


def sql_token_spots(tokens: str) -> str:
    """The same in DuckDB, step by step: buckets of a token list, their counts, the unit vector."""
    return (f"list_transform({tokens}, lambda t: (strpos('{HEX}', substr(md5(t), 1, 1)) - 1) * 4 + "
            f"(strpos('{HEX}', substr(md5(t), 2, 1)) - 1) // 4)")


def sql_spot_counts(spots: str) -> str:
    return f"list_transform(range(64), lambda k: CAST(len(list_filter({spots}, lambda s: s = k)) AS DOUBLE))"


def sql_unit_vector(counts: str) -> str:
    norm = f"sqrt(list_sum(list_transform({counts}, lambda x: x * x)))"
    return (f"CASE WHEN list_sum({counts}) = 0 THEN list_transform({counts}, lambda x: CAST(0 AS FLOAT)) "
            f"ELSE list_transform({counts}, lambda x: CAST(x / {norm} AS FLOAT)) END")


#: Texts of one call of a model.
ENCODE_ROWS = 64
_MODELS: dict[str, Any] = {}


def pandas_encoder(df: DataFrame, make_model, text_col: str = "document", rows: int = ENCODE_ROWS) -> DataFrame:
    """User-supplied model applied through an iterator pandas UDF.

    ``make_model()`` returns a callable ``encode(list[str]) -> list[list[float]]``; a Python worker calls it
    once, however many of this query's tasks it runs, and ``encode`` gets ``rows`` texts a call (the last call of a task may
    get fewer, whatever the sizes of its Arrow batches).  A null text is encoded as ''."""
    import uuid

    import pandas as pd

    workers_see_package(df.sparkSession)
    token = uuid.uuid4().hex

    def encoded(batches):
        from commentspark.operators import index as worker

        if token not in worker._MODELS:
            worker._MODELS.clear()  # models of earlier queries
            worker._MODELS[token] = make_model()
        encode = worker._MODELS[token]
        # Vectors go out in series as long as the batches that came in.
        waiting: list[str] = []
        sizes: list[int] = []
        vectors: list = []

        def ready():
            while sizes and len(vectors) >= sizes[0]:
                n = sizes.pop(0)
                out, vectors[:] = vectors[:n], vectors[n:]
                yield pd.Series(out, dtype=object)

        for batch in batches:
            waiting += ["" if t is None else t for t in batch.tolist()]
            sizes.append(len(batch))
            while len(waiting) >= rows:
                some, waiting[:] = waiting[:rows], waiting[rows:]
                vectors += list(encode(some))
            yield from ready()
        if waiting:
            vectors += list(encode(waiting))
        yield from ready()

    as_udf = F.pandas_udf(encoded, T.ArrayType(T.FloatType()), F.PandasUDFType.SCALAR_ITER)
    return df.withColumn("embedding", as_udf(F.col(text_col)))
