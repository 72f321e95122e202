import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from commentspark.llm import simhash


def brute_fingerprints(spark, texts):
    """Fingerprints bit by bit; only the term hash is Spark's."""
    runs = []
    for t in texts:
        words = re.findall(r"[^\W_]+", t.lower())
        runs.append([words[i:i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [words])
    every = [list(r) for r in {tuple(r) for own in runs for r in own}]
    df = spark.createDataFrame([(r,) for r in every], "r array<string>")
    hashed = {tuple(x.r): x.h & (2**64 - 1) for x in df.select("r", F.xxhash64("r").alias("h")).collect()}
    out = []
    for own in runs:
        votes = [sum(1 if hashed[tuple(r)] >> j & 1 else -1 for r in own) for j in range(64)]
        out.append(sum(1 << j for j in range(64) if votes[j] > 0))
    return out


def expected(spark, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    texts = [t or "" for _, t in rows]
    following = texts[1:] + texts[:1]
    edits = [t[:len(t) - len(t) // 4] + (n[:len(t) // 4]) for t, n in zip(texts, following)]
    own, changed = brute_fingerprints(spark, texts), brute_fingerprints(spark, edits)
    like = lambda a, b: 1 - (a ^ b).bit_count() / 64
    return [(r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), f"{f:016x}", f"{g:016x}", like(f, g), like(f, own[(i + 1) % len(own)]))
            for i, (r, t, e, f, g) in enumerate(zip(rows, texts, edits, own, changed))]


def got_rows(found):
    f = F.col
    return [tuple(r) for r in found.select("id", "n_chars", "edited_sha256", simhash.hexed(f("fingerprint")), simhash.hexed(f("edited")),
                                            simhash.likeness(f("fingerprint"), f("edited")), simhash.likeness(f("fingerprint"), f("next"))).collect()]


@pytest.mark.parametrize("range_rows", [2_000, 3])
def test_against_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr(simhash, "RANGE_ROWS", range_rows)
    rng = random.Random(7)
    words = ["été", "house", "tree", "Wasser", "42", "río", "🙂x", "a"]
    rows = [(rng.choice([1, 10**12]) * i, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 5, 6, 40])))) for i in range(40)]
    rows += [(None, "no id here at all, really"), (7, None), (7, ""), (7, "same"), (7, "same"), (-5, "x " * 30_000), (10**12 * 50, "last one of them all")]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, range int")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got_rows(simhash.edited_pairs(df)), key=key) == sorted(expected(spark, rows), key=key)


def test_one_and_none(spark):
    one = spark.createDataFrame([(3, "only one document here")], "doc_id long, text string")
    assert got_rows(simhash.edited_pairs(one)) == expected(spark, [(3, "only one document here")])
    assert simhash.edited_pairs(one.limit(0)).count() == 0


def test_near_finds_every_pair(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(60)]
    every = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(20)}
    signed = [x - (1 << 64) if x >> 63 else x for x in every]
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    for radius, blocks in ((3, 5), (2, 4), (3, 6)):
        got = {(r.query, r.fingerprint): r.distance for r in simhash.near(df.limit(100), df, radius, blocks).collect()}
        asked = {r.fingerprint for r in df.limit(100).collect()}
        want = {(a, b): ((a ^ b) & (2**64 - 1)).bit_count() for a in asked for b in signed}
        assert got == {p: d for p, d in want.items() if d <= radius}


def test_fingerprints_are_those_of_the_pairs(spark):
    df = spark.createDataFrame([(i, f"text number {i} with a few more words in it " * 3) for i in range(9)], "doc_id long, text string")
    a = {r.doc_id: r.fingerprint for r in simhash.fingerprints(df).collect()}
    assert a == {r.id: r.fingerprint for r in simhash.edited_pairs(df).collect()}


def test_query_whole_table(spark):
    from commentspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = QUERIES["op4_simhash"](spark, sf)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
    got = sorted(out.collect())
    assert [tuple(r)[:7] for r in got] == sorted(expected(spark, rows))
    prints = [int(r.fingerprint, 16) for r in got]
    for r in got:
        near = sum((int(r.fingerprint, 16) ^ p).bit_count() <= 3 for p in prints) - 1
        assert r.n_near == (near if r.doc_id % 50 == 0 else None)
