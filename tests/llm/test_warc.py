import hashlib
import os
from collections import defaultdict

import duckdb

from commentspark.llm import warc


def brute(rows):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        top = max((p for p in groups[html or ""] if p is not None), default=None)
        again = len(body) >= 1000 and len(groups[html or ""]) > 1 and top is not None and page != top
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/x", "é" * 600), (5, "http://b/", "é" * 600), (3, None, "é" * 600), (7, "http://c\r\nWARC-Type: evil", None), (8, "u", ""), (9, "u", "short"),
        (10, "u", "short"), (11, "u", "x" * 999), (12, "u", "x" * 999), (13, "u", "y" * 1000), (14, "u", "y" * 1000), (14, "u", "y" * 1000),
        (None, "u", "y" * 1000), (15, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 40_000), (None, "n", "z" * 2000), (None, "n", "z" * 2000), (14, "u", "other")]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string").repartition(3)
    index = warc.write(pages)
    got = warc.read(index).collect()
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS)
    texts = {r[2] or "" for r in ROWS}
    assert all((r.payload is None) if r.record_type == "revisit" else r.payload.decode() in texts for r in got)
    some = warc.read(index.filter("id in (1, 9, 15)"), with_payload=False).collect()
    assert sorted(r.id for r in some) == [1, 9, 15] and {r.url for r in got if r.id == 7} == {"http://c%0D%0AWARC-Type: evil"}


def test_archives_are_read_by_many_tasks_and_dropped(spark):
    from urllib.parse import urlparse

    from commentspark import session

    pages = spark.createDataFrame([(k, f"http://h/{k}", f"page {k} " * 50) for k in range(400)], "page_id long, url string, html string").repartition(8)
    index = warc.write(pages)
    folders = {r.file.rsplit("/", 1)[0] for r in index.select("file").distinct().collect()}
    assert index.select("file").distinct().count() == 8 and len(folders) == 1
    found = warc.read(index, with_payload=False)
    from pyspark.sql import functions as F
    assert found.count() == 400 and found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    folder = urlparse(folders.pop())
    assert folder.scheme == "file" and os.listdir(folder.path)
    session.drop_written(spark)
    assert not os.path.exists(folder.path)


def test_reads_are_coalesced():
    ranges = [(0, 10), (10, 10), (100, 5), (10_000_000, 4)]
    assert warc.coalesced(ranges, gap=50, span=1000) == [[0, 1], [2], [3]]
    assert warc.coalesced(ranges, gap=90, span=1000) == [[0, 1, 2], [3]]
    assert warc.coalesced(ranges, gap=90, span=20) == [[0, 1], [2], [3]]


def test_empty_table(spark):
    assert warc.read(warc.write(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_query_against_sql(spark):
    from commentspark.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    want = con.execute(ORACLE["op6_warc"]).fetchall()
    assert sorted(map(tuple, QUERIES["op6_warc"](spark, sf).collect())) == sorted(want)
