import base64
import hashlib
import struct

import public_tokenizers as P
import pytest
import tiktoken

from commentspark.llm import bpe

VOCAB = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCAB, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", "a", "Élan d'être là\n\n  fin ", "x" * 500, " " * 300 + "y", "we're 'r" * 60, "\n\n\t a\n\n" * 40,
         "日本語テキスト🙂 " * 30, "<|endoftext|> ok", "it's they'll'd " * 70, "word " * 200 + "z" * 400 + " tail"]


@pytest.mark.parametrize("chunk,overlap", [(32_768, 1_024), (40, 16), (64, 8)])
def test_round_trip_and_ids(spark, reference, chunk, overlap):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], 0)]  # a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    ids = bpe.encode(docs, VOCAB, P.PATTERN, chunk_chars=chunk, overlap=overlap)
    got = sorted((r.doc_id, bytes(r.coded), bytes(r.bytes)) for r in bpe.decode(ids.withColumn("coded", ids["ids"]), VOCAB, P.PATTERN).collect())
    want = sorted((i, struct.pack(f"<{len(e)}I", *e), (t or "").encode()) for i, t, _ in rows for e in [reference.encode_ordinary(t or "")])
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, VOCAB, P.PATTERN), VOCAB, P.PATTERN).count() == 0


def test_query_whole_table(spark, reference):
    from commentspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op1_bpe_codec"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        e = reference.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(e), hashlib.sha256(struct.pack(f"<{len(e)}I", *e)).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
