"""Structured Streaming forms of the incremental index (Z1) and of id
de-duplication (Z2), over a landing folder of page files.

Z1: each micro-batch is flattened, enriched and appended by the batch index
builder, which skips ids already there, so a replay after a failure, or a
second run, adds nothing.  Landing, index and checkpoint folders are the
caller's, in storage that the whole cluster shares.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.predicates import doc_pred_keys
from ..operators import index as IX
from ..operators import postings as PO
from ..operators.entities import extract_entities
from ..operators.sentiment import score_sentiment
from ..session import materialize, read_note


def enrich_batch(rows: DataFrame, lexicon: dict, patterns: list) -> DataFrame:
    c = T.with_clean_text(rows)
    c = score_sentiment(c, "clean_text", lexicon)
    return c.withColumn("entities", extract_entities(F.col("clean_text"), patterns))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream whose progress the checkpoint keeps, the same in every run."""
    return json.loads(read_note(spark, checkpoint + "/metadata"))["id"]


def run_stream_index(spark: SparkSession, landing: str, index_path: str, checkpoint: str, lexicon: dict, patterns: list,
                     postings_path: str | None = None, page_files: int | None = None) -> None:
    """Index what has landed since the checkpoint (availableNow), then return.

    With ``postings_path`` the same micro-batch keeps up the BM25 postings and their statistics: a posting batch is named by stream and
    micro-batch, so one that is repeated replaces itself, and documents that other batches hold are left out.  Its documents are
    the index's rows, so both hold the same text.  ``page_files`` bounds the files of a micro-batch."""
    def upsert(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        rows = IX.flatten_pages(batch).drop("_file", "_seq")
        if postings_path is None:
            IX.build_index(session, enrich_batch(rows, lexicon, patterns), index_path)
            return
        rows = materialize(enrich_batch(rows, lexicon, patterns), "stream-batch")
        IX.build_index(session, rows, index_path)
        ids = IX.prepare_index_rows(rows).select("id").distinct()
        docs = IX.read_index(session, index_path).join(ids, "id", "left_semi")
        docs = docs.withColumn("pred_keys", doc_pred_keys(F.col("sentiment_polarity"), F.col("topic_id")))
        postings = PO.opened(session, postings_path) or PO.create(session, postings_path)
        PO.add_batch(postings, docs, f"{stream_id(session, checkpoint)}-{epoch}")

    reader = spark.readStream.schema(IX.PAGE_SCHEMA)
    if page_files is not None:
        reader = reader.option("maxFilesPerTrigger", page_files)
    (reader.json(landing).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def stream_dedup(spark: SparkSession, landing: str, out: str, checkpoint: str, watermark: str = "1 hour") -> DataFrame:
    """Z2: one row per comment id within the watermark
    (``dropDuplicatesWithinWatermark``); a row later than the watermark is dropped."""
    rows = IX.flatten_pages(spark.readStream.schema(IX.PAGE_SCHEMA).json(landing))
    rows = rows.withColumn("event_time", F.to_timestamp("published_at"))
    dedup = rows.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["comment_id"])
    (dedup.select("comment_id", "video_id").writeStream.format("parquet")
     .option("checkpointLocation", checkpoint).option("path", out)
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("comment_id string, video_id string").parquet(out)
