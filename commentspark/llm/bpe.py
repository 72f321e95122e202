"""Operator 1: byte-level BPE encoding and decoding.

Overlapping chunk encoding.  A text is cut into chunks of ``chunk_chars``
characters, each reaching ``overlap`` characters into the next one.  Chunks are
pre-tokenised independently.  The pre-token pattern looks only forward, so two
runs that share one boundary agree from there on; the first boundary that both
neighbours report inside their overlap is where the texts are stitched.  The
pieces between stitches are encoded on their own and the ids concatenated.
Decoding concatenates the raw bytes of the ids.

Boundaries reported for stitching follow a non-space character (a negative
look-ahead at the end of a piece could otherwise see the end too early) and lie
at least ``LOOKAHEAD`` characters before the chunk's end.  If some overlap of a
text holds no common boundary (one token longer than the overlap), that text
is pre-tokenised whole: exact for every input.

Defined cases: a null text encodes as the empty text (no ids, no bytes); every
input row gives one output row, repeated rows included; other columns of the
input are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CHUNK_CHARS = 32_768
OVERLAP = 1_024
#: Longest forward reach of a pattern alternative of fixed length ('re, 've, 'll).
LOOKAHEAD = 3

_ENCODINGS: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The rank file at ``path`` (readable on every worker) with ``pattern``; one per process."""
    if (path, pattern) not in _ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def boundaries(text: str, start: int, pattern: regex.Pattern, low: int, high: int) -> list[int]:
    """Offsets (``start`` added) in [low, high] where a pre-token begins after a non-space character."""
    found = []
    for match in pattern.finditer(text):
        at = match.start()
        if start + at > high:
            break
        if start + at >= low and at > 0 and not text[at - 1].isspace():
            found.append(start + at)
    return found


def _ids(text: str, enc: tiktoken.Encoding) -> bytes:
    ids = array("I", enc.encode_ordinary(text))
    if ids.itemsize != 4:
        ids = array("L", ids)
    return ids.tobytes()


def _encode_column(df: DataFrame, text_col: str, path: str, pattern: str) -> DataFrame:
    """Replaces ``text_col`` by ``ids``; other columns stay."""
    keep = [c for c in df.columns if c != text_col]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "ids binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in common.slices(batches):
            texts = batch.column(text_col)
            ids = pa.array([_ids(t.as_py() or "", enc) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, "ids"])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """One row per input row: ``id_col`` and ``ids`` (binary, little-endian unsigned 32-bit)."""
    common.workers_see_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    whole = F.length("text") <= chunk_chars + overlap
    short = _encode_column(rows.filter(whole), "text", vocab, pattern)
    return short.unionByName(_encode_chunked(rows.filter(~whole), vocab, pattern, chunk_chars, overlap)).withColumnRenamed("id", id_col)


def _encode_chunked(rows: DataFrame, vocab: str, pattern: str, chunk_chars: int, overlap: int) -> DataFrame:
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    last = F.ceil((F.length("text") - overlap) / chunk_chars).cast("int") - 1
    cut = F.explode(F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(
        k.alias("chunk"), F.expr("text").substr(k * chunk_chars + 1, F.lit(chunk_chars + overlap)).alias("text"))))
    chunks = keyed.select("id", "row", cut.alias("c")).select("id", "row", "c.chunk", "c.text")
    # Chunks of one long text go to different tasks.
    chunks = common.stored(_pretokenised(chunks.repartition("row", "chunk"), pattern, chunk_chars, overlap), "bpe-chunks")

    in_text = Window.partitionBy("row").orderBy("chunk")
    marks = chunks.select("row", "chunk", "head", "tail", "size")
    marks = marks.withColumn("cut", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(
        F.array_min(F.array_intersect(F.lag("tail").over(in_text), "head"))))
    marks = (marks.withColumn("stitched", F.min(F.col("cut").isNotNull()).over(Window.partitionBy("row")))
             .withColumn("upto", F.coalesce(F.lead("cut").over(in_text), F.col("chunk") * chunk_chars + F.col("size")))
             .select("row", "chunk", "cut", "upto", "stitched"))
    joined = chunks.join(marks, ["row", "chunk"])
    pieces = joined.filter("stitched").select("id", "row", "chunk", F.expr(
        f"substring(text, cut - chunk * {chunk_chars} + 1, upto - cut)").alias("text"))
    # A text without a common boundary in some overlap: put together again, one piece.
    core = F.struct("chunk", F.when(F.lead("chunk").over(in_text).isNull(), F.col("text"))
                    .otherwise(F.col("text").substr(1, chunk_chars)).alias("text")).alias("core")
    unstitched = (joined.filter(~F.col("stitched")).select("id", "row", core)
                  .groupBy("id", "row").agg(F.array_sort(F.collect_list("core")).alias("cores"))
                  .select("id", "row", F.lit(0).alias("chunk"), F.array_join("cores.text", "").alias("text")))
    encoded = _encode_column(pieces.unionByName(unstitched), "text", vocab, pattern)
    grouped = encoded.groupBy("id", "row").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))

    def joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"".join(parts.as_py()) for parts in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary())], ["id", "ids"])

    return grouped.select("id", F.col("parts.ids").alias("ids")).mapInArrow(
        joined_up, f"id {rows.schema['id'].dataType.simpleString()}, ids binary")


def _pretokenised(chunks: DataFrame, pattern: str, chunk_chars: int, overlap: int) -> DataFrame:
    """Adds the boundaries in the chunk's first and last ``overlap`` characters, as offsets in the text."""
    id_type = chunks.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            heads, tails, sizes = [], [], []
            for k, text in zip(batch.column("chunk").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = k * chunk_chars
                found = boundaries(text, start, compiled, start, start + len(text) - LOOKAHEAD)
                heads.append([p for p in found if p <= start + overlap] if k else [])
                tails.append([p for p in found if p >= start + chunk_chars])
                sizes.append(len(text))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "row", "chunk", "text")), pa.array(heads, longs), pa.array(tails, longs),
                 pa.array(sizes, pa.int64())], ["id", "row", "chunk", "text", "head", "tail", "size"])

    return chunks.select("id", "row", "chunk", "text").mapInArrow(
        run, f"id {id_type}, row long, chunk int, text string, head array<long>, tail array<long>, size long")


def decode(encoded: DataFrame, vocab: str, pattern: str) -> DataFrame:
    """Replaces ``ids`` by ``bytes``: the raw bytes of the ids, one after another (null ids: null)."""
    common.workers_see_package(encoded.sparkSession)
    keep = [c for c in encoded.columns if c != "ids"]
    schema = ", ".join([*(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep), "bytes binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocab, pattern)
        size = 1 + max(enc._mergeable_ranks.values())
        table: list[bytes] = [b""] * size
        for token, rank in enc._mergeable_ranks.items():
            table[rank] = token
        raw = table.__getitem__
        for batch in common.slices(batches):
            out = []
            for ids in batch.column("ids"):
                ids = ids.as_py()
                out.append(None if ids is None else b"".join(map(raw, memoryview(ids).cast("I"))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.binary())], [*keep, "bytes"])

    return encoded.mapInArrow(run, schema)
