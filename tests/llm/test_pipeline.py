"""Every stage of the pipeline against a brute-force version of it, on the stage before's output."""

import re
from collections import defaultdict

import public_tokenizers as P
import pytest
import test_line_dedup
import test_ngram_join
import test_pii
from tokenizers import Tokenizer

import corpus_pipeline
from commentspark.llm import common

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = common.read(spark, SF, "documents"), {}
    extra = spark.createDataFrame([(10**6, None, "en", "odd", 0), (10**6 + 1, "", None, None, 0), (10**6 + 2, "12 34 !!", "fr", "odd", 8),
                                   (10**6 + 3, None, None, None, None)], docs.schema)
    docs = common.stored(docs.unionByName(extra), "test-docs")
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert docs.columns == COLUMNS
        out[name] = docs.collect()
    return out


def test_language_id_keeps_all_prose(steps):
    kept = {r.doc_id for r in steps["language_id"]}
    assert all((r.doc_id in kept) == bool(re.search(r"[^\W\d_]", r.text or "")) for r in steps["documents"])
    assert set(steps["language_id"]) <= set(steps["documents"])


def test_stage_line_dedup(steps):
    want = {}
    before = [(r.doc_id, r.text) for r in steps["language_id"]]
    for (i, old), (_, new) in zip(before, test_line_dedup.brute(before), strict=True):
        if new == old or any(test_line_dedup.takes_part(test_line_dedup.tokens_of(x)) for x in new.split("\n")):
            want[i] = new
    assert {r.doc_id: r.text for r in steps["line_dedup"]} == want
    assert all(r.n_chars == len(r.text) for r in steps["line_dedup"])


def test_stage_near_copies(steps):
    want = {c for _, c, _ in test_ngram_join.brute([(r.doc_id, r.text) for r in steps["line_dedup"]])}
    assert sorted(r.doc_id for r in steps["ngram_jaccard"]) == sorted(want) and set(steps["ngram_jaccard"]) <= set(steps["line_dedup"])


def test_stage_pii(steps):
    before, after = ({r.doc_id: r for r in steps[s]} for s in ("ngram_jaccard", "pii"))
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not test_pii.brute(r.text) and not re.search("AKIA[A-Z0-9]{16}", r.text) and r.n_chars == len(r.text)
        if not re.search(r"[0-9]|@|password", before[i].text):
            assert r == before[i]


def test_stage_packing(steps):
    tk, by_doc, by_seq = Tokenizer.from_file(P.path("byte_bpe_50k.json")), defaultdict(list), defaultdict(int)
    for r in steps["packing"]:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id] += r.length
    for r in steps["pii"]:
        ids = b"".join(bytes(x.ids) for x in sorted(by_doc.pop(r.doc_id), key=lambda x: x.piece))
        assert list(memoryview(ids).cast("H")) == [*tk.encode(r.text, add_special_tokens=False).ids, 2]
    assert not by_doc and max(by_seq.values()) <= 1024 and sum(by_seq.values()) / len(by_seq) > 1000


CLASHING = ["score", "lang_pred", "key", "place", "candidates", "n_lines", "n_dropped", "id", "d", "line", "words", "ids", "length"]


@pytest.mark.parametrize("rows", [0, 60])
def test_empty_and_clashing_columns(spark, rows):
    docs = common.read(spark, SF, "documents").limit(rows)
    docs = docs.select("*", *(docs["source"].alias(c) for c in CLASHING))
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, SF), f"clash-{name}")
        assert name == "packing" or out.columns == [*COLUMNS, *CLASHING]
        assert (out.count() > 0) == (rows > 0)
        docs = out


def test_key_names_itself_in_spark_and_in_the_join(spark):
    docs = common.read(spark, SF, "documents").limit(30)
    from commentspark.llm import ngram_join

    here = {r.doc_id: r.k for r in docs.select("doc_id", ngram_join.key_of(docs["text"]).alias("k")).collect()}
    assert here == {r.doc_id: r.key for r in ngram_join.near_copies(docs).collect()}


def test_line_dedup_keeps_lines_before_blanks(spark):
    shared, ends = "this license line is shared", ["\r\n", " \n", "\t\n", " \r\n", "\f\n", "\n", "\n\r\r\n"]
    own = [" ".join("abcdefghijklmnopqrstu"[i] + x for x in ("lpha", "eta", "amma", "elta")) for i in range(21)]
    rows = [(i, ends[i // 3].join([shared, own[i], ""])) for i in range(21)]
    rows += [(100, shared + "\r\n"), (101, shared + " \r\n\r\n"), (102, shared + "\r\nup to three \r\n"), (103, shared + "\n" + "\r" * 100_000 + "\n")]
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()}
    brute = dict(test_line_dedup.brute(rows))
    assert {i: brute[i] for i in range(21)} == {i: got.get(i) for i in range(21)}
    assert not {100, 101, 103} & got.keys()


def test_line_dedup_keeps_short_lines_of_their_own(spark):
    shared = "this license line is shared"
    left = ["\n".join(["Roses", "are red \r"]), "\u4e00\u884c\u5b57" * 9, "first verse\nsame verse", "same  verse\nsame verse", "same verse", "both have", "both have", "", "lone line", "in a text"]
    rows = [(None, shared + "\nfor null ids"), (0, shared)] + [(i, shared + "\n" + x) for i, x in enumerate(left, 1)]
    rows += [(50, "in a text"), (51, "in a text\nand a line of some more words"), (52, None), (53, ""), (3, shared + "\nunder one id")]
    df = spark.createDataFrame([(a, b, True, 7) for a, b in rows], "doc_id long, text string, poor boolean, d int")
    out = corpus_pipeline.lines(spark, df, SF)
    assert out.columns == df.columns
    got = {(r.doc_id, r.text) for r in out.collect()}
    gone = {(0, shared)} | {(i, rows[i + 1][1]) for i in (4, 5, 7, 8, 10)}
    brute = list(test_line_dedup.brute(rows))
    assert got == {new for old, new in zip(rows, brute, strict=True) if old not in gone}
