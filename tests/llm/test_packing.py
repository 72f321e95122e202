import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from commentspark.llm import packing
from commentspark.sources.bucketed import setting

VOCAB = P.path("byte_bpe_50k.json")


def one_by_one(lengths, capacity):
    """Best-fit decreasing with a plain search: the remaining capacities of its bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in range(len(bins)) if bins[b] >= n]
        if fits:
            bins[min(fits, key=lambda b: bins[b])] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 100, 1024])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 600))] + [rng.randint(1, capacity)] * 200
    histogram = defaultdict(int)
    for n in lengths:
        histogram[n] += 1
    fill, seen, spans = defaultdict(int), defaultdict(int), defaultdict(list)
    steps = sorted(packing.plan(histogram, capacity))
    for i, (n, rank, first, offset) in enumerate(steps):
        upto = steps[i + 1][1] if i + 1 < len(steps) and steps[i + 1][0] == n else histogram[n]
        seen[n] += upto - rank
        for b in range(first, first + upto - rank):
            fill[b] += n
            spans[b].append((offset, n))
    assert seen == histogram
    for b in spans:
        at = 0
        for offset, n in sorted(spans[b]):
            assert offset == at
            at += n
    assert sorted(capacity - f for f in fill.values()) == one_by_one(lengths, capacity)


def test_documents(spark):
    texts = [None, "", "hi", "a b " * 900, "x" * 3000, "<|endoftext|> end", "Élan\n\n  là", "the " * 1023, "the " * 1024] + ["copy of it"] * 30
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, length long")
    pieces = packing.cut(packing.tokenise(docs, VOCAB, P.PATTERN)).cache()
    out = packing.pack(pieces).collect()
    tk = Tokenizer.from_file(VOCAB)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids, rows = tk.encode(t or "", add_special_tokens=False).ids + [2], sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows)))
        assert b"".join(bytes(r.ids) for r in rows) == struct.pack(f"<{len(ids)}I", *ids)
        at = 0
        for r in rows:
            assert r.start == at and r.length * 4 == len(r.ids) and (r.piece == 0 or r.length == 1024)
            at += r.length
        assert len(rows) == -(-len(ids) // 1024)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_seq) == len(one_by_one([r.length for r in out], 1024))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.cut(packing.tokenise(docs, VOCAB, P.PATTERN))).count() == 0


def test_query_matches_tokenizers(spark):
    from commentspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    tk = Tokenizer.from_file(VOCAB)
    got = {(r.doc_id, r.piece): r for r in QUERIES["op5_best_fit_packing"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids, at, k = tk.encode(r.text or "", add_special_tokens=False).ids + [2], 0, 0
        while at < len(ids):
            row = got.pop((r.doc_id, k))
            part = ids[at:at + row.length]
            assert row.start == at and row.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at, k = at + row.length, k + 1
    assert not got


@pytest.mark.parametrize("sent", [packing.SENT_PAIRS, 0])
def test_stored_pieces_are_placed_where_they_lie(spark, tmp_path, monkeypatch, sent):
    """A piece's ids are not shuffled to be placed, unless the counts are too many to send to the tasks."""
    monkeypatch.setattr(packing, "SENT_PAIRS", sent)
    rng = random.Random(7)
    rows = [(i, 0, rng.choice([1, 3, 500, 1024, rng.randint(1, 1024)]), b"ids") for i in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids binary").repartition(7)
    packing.numbered(pieces).write.parquet(str(tmp_path / "pieces"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = packing.pack(spark.read.parquet(str(tmp_path / "pieces")))
        plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning(_deal" in line]
    assert bool(moved) == (not sent)
    assert out.columns == ["doc_id", "piece", "length", "ids", "sequence_id", "offset"]
    by_seq = defaultdict(list)
    for r in out.collect():
        by_seq[r.sequence_id].append((r.offset, r.length, r.doc_id))
    assert sorted(d for s in by_seq.values() for _, _, d in s) == list(range(3000))
    for s in by_seq.values():
        at = 0
        for offset, length, _ in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_seq) == len(one_by_one([r[2] for r in rows], 1024))
