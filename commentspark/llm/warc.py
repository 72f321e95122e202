"""Operator 6: WARC archives, index first.

``write`` makes one archive per task in a folder that all executors share, and an index
row per record: file, offset, length, id, URL, payload digest, type.  Spark commits the index;
an archive of an attempt that was lost has no index row and is never read.  ``read``
starts from the index, whole or filtered: its byte ranges are sorted by file and offset,
ranges that lie close together become one read, and the records are parsed from it.

A record holds an HTTP response with the payload.  Of the records with equal payloads of
at least ``MIN_REVISIT`` bytes that with the largest id is the response; the others are
revisits, which hold the headers only and name the response.  Which one that is comes from an
aggregation over (digest, id), which combines before it shuffles; payloads are moved at
most once, by id.

Archives are opened through ``pyarrow.fs``, which reads and writes local, HDFS, S3 and GCS
folders; Spark reads the input.

Defined cases: a null payload is empty; every input row gives one record, repeated rows
included (of several rows with the largest id, all are responses); a null id never is the
response that others revisit unless all ids of the group are null; control characters in a
URL are percent-encoded, a null URL has no header line; an empty table gives no archive, an empty
index and no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentspark import session

from . import common

MIN_REVISIT = 1_000
DATE = "2020-01-01T00:00:00Z"
#: Ranges at most so far apart are read at once, up to so many bytes.
GAP, SPAN = 65_536, 8 << 20
#: Bytes of an archive that one task reads, about.
SEGMENT = 64 << 20

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("file string, offset long, length long, id long, url string, payload_digest string, payload_bytes long, "
         "record_type string, refers_to long")
CONTROL = {c: f"%{c:02X}" for c in [*range(32), 127]}


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file, as Spark names it."""
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, from version line to closing blank lines."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {url.translate(CONTROL)}")
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    block = http if revisit else http + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """Header fields of a record, payload length that its HTTP headers name, payload that it holds."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line.split(b": ")[1]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
    return fields, size, payload


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:"):-1]) if urn and urn != "<urn:page:>" else None


def revisits(pages: DataFrame, id_col: str, digest: Column, size: Column, min_bytes: int) -> DataFrame:
    """(id, digest, keeper) of the records that are revisits."""
    facts = pages.select(F.col(id_col).cast("long").alias("id"), digest.alias("digest"), size.alias("size")).filter(F.col("size") >= min_bytes)
    keepers = facts.groupBy("digest").agg(F.max("id").alias("keeper"), F.count("*").alias("n")).filter("n > 1 and keeper is not null")
    return facts.join(keepers.select("digest", "keeper"), "digest").filter(~F.col("id").eqNullSafe(F.col("keeper"))).select("id", "digest", "keeper").distinct()


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_REVISIT,
          folder: str | None = None) -> DataFrame:
    """Writes the archives; the index, a stored table with the columns of ``INDEX``.  Without a ``folder`` both go with the query's
    other tables (``session.drop_written``)."""
    spark = pages.sparkSession
    common.workers_see_package(spark)
    # A name without scheme means the cluster's default file system, not each executor's disk.
    folder = session.qualified(spark, folder or session.fresh_path(spark, "warc")).rstrip("/")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    digest, size = F.sha1(payload), F.octet_length(payload)
    again = common.stored(revisits(pages, id_col, digest, size, min_bytes), "revisits").withColumnsRenamed({"id": "r_id", "digest": "r_digest"})
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), digest.alias("digest"))
    rows = rows.join(again, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    rows = rows.select("id", "url", "payload", "digest", "keeper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        name, out, at = None, None, 0
        try:
            for batch in common.slices(batches, 256):
                if out is None:
                    system.create_dir(path, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc"
                    out = system.open_output_stream(f"{path}/{name}", buffer_size=1 << 20)
                index = []
                for page, url, body, sha, keeper in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "keeper")), strict=True):
                    raw = record(page, url, body, sha, keeper, keeper is not None)
                    out.write(raw)
                    index.append((f"{folder}/{name}", at, len(raw), page, url, sha, len(body), "response" if keeper is None else "revisit", keeper))
                    at += len(raw)
                columns = list(zip(*index, strict=True))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
                names = [c.split()[0] for c in INDEX.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        finally:
            if out is not None:
                out.close()

    return common.stored(rows.mapInArrow(run, INDEX), "warc-index")


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP, span: int = SPAN) -> list[list[int]]:
    """Positions in sorted (offset, length) ranges, grouped into reads."""
    reads: list[list[int]] = []
    for k, (offset, length) in enumerate(ranges):
        if reads:
            first, last = ranges[reads[-1][0]], ranges[reads[-1][-1]]
            if offset - (last[0] + last[1]) <= gap and offset + length - first[0] <= span:
                reads[-1].append(k)
                continue
        reads.append([k])
    return reads


def read(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """(id, url, record_type, refers_to, payload_bytes, payload_digest[, payload]) of the records in ``index``.

    The digest is that of the payload read, and has to be the one the header names; a
    revisit's is the header's, and its payload is null.
    """
    common.workers_see_package(index.sparkSession)
    at = index.select("file", (F.col("offset") / SEGMENT).cast("long").alias("segment"), "offset", "length")
    # As many tasks as segments: a task reads what the index names, so the index's own size says nothing of its work.
    segments = at.groupBy("file", "segment").agg(F.lit(1)).count()
    at = at.repartition(max(1, segments), "file", "segment").sortWithinPartitions("file", "offset").select("file", "offset", "length")
    names = ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", *(["payload"] if with_payload else [])]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if with_payload else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        try:
            for batch in common.slices(batches, 1_024):
                files, ranges = batch.column("file").to_pylist(), list(zip(batch.column("offset").to_pylist(), batch.column("length").to_pylist(), strict=True))
                low = 0
                while low < len(files):
                    high = next((k for k in range(low, len(files)) if files[k] != files[low]), len(files))
                    if files[low] != name:
                        if file is not None:
                            file.close()
                        name = files[low]
                        system, path = opened(name)
                        file = system.open_input_file(path)
                    own = ranges[low:high]
                    for group in coalesced(own):
                        start = own[group[0]][0]
                        file.seek(start)
                        raw = file.read(own[group[-1]][0] + own[group[-1]][1] - start)
                        rows = [_row(raw[own[k][0] - start:own[k][0] - start + own[k][1]], with_payload) for k in group]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    low = high
        finally:
            if file is not None:
                file.close()

    schema = "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string" + (", payload binary" if with_payload else "")
    return at.mapInArrow(run, schema)


def _row(raw: bytes, with_payload: bool) -> tuple:
    fields, size, payload = parsed(raw)
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    row = (_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"], _page(fields.get("WARC-Refers-To")), size, digest)
    return (*row, payload if whole else None) if with_payload else row
