import random
import re

import numpy as np
import pytest

from commentspark.llm import ngram_join


def shingles(text, n=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    root, count = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                count[i] += 1
                count[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), k), k)
    return sorted((k, low[find(i)], count[i]) for i, (k, _) in enumerate(rows))


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([3, 8, 60, 150]))] for _ in range(20)]
    rows = []
    for k in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 12])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((k * 7, (", " if k % 3 else "  ").join(words).upper() if k % 5 == 0 else " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [1_000, 8])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SIGNATURES", block)
    rows = corpus(4) + [(5000, None), (5001, ""), (5002, " .. !"), (5003, "one two"), (5004, "One, two"), (5005, "x" * 100_000), (7, corpus(4)[0][1]), (7, corpus(4)[0][1])]
    df = spark.createDataFrame([(a, b, a) for a, b in rows], "doc_id long, text string, key long")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.near_copies(df).collect())
    assert got == brute(rows)


def test_documents_of_one_template_are_no_candidates(spark, monkeypatch):
    """Pages that share half of their words meet in buckets, but none sends its n-grams or joins a group."""
    rng, template = random.Random(8), " ".join(f"t{i}" for i in range(120))
    rows = [(k, template + " " + " ".join(f"own{k}x{rng.randrange(10**6)}" for _ in range(120))) for k in range(400)]
    rows += [(1000 + k, rows[k][1] + " more") for k in range(3)]
    groups = []
    verified = ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda texts, found, *more: groups.append(found.count()) or verified(texts, found, *more))
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert groups == [6]
    assert got == {k: (k % 1000, int(k % 1000 < 3)) for k, _ in rows}


def test_joining_by_signatures():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 30, (12, ngram_join.HASHES), dtype=np.uint32)
    rows = [(k, np.where(rng.random(ngram_join.HASHES) < 0.05, rng.integers(0, 1 << 30, ngram_join.HASHES, dtype=np.uint32), base[k])) for k in rng.integers(0, 12, 90)]
    part = ngram_join.joined(np.stack([r for _, r in rows]), ngram_join.least_matches())
    first = {}
    assert [first.setdefault(k, i) for i, (k, _) in enumerate(rows)] == part.tolist()


def test_long_document_hashes_do_not_depend_on_its_length():
    words = " ".join(f"t{i}" for i in range(40_000)).encode()
    whole = ngram_join.grams(words, ngram_join._powers(16))
    part = ngram_join.grams(b" ".join(words.split()[20_000:20_100]), ngram_join._powers(16))
    assert len(whole) == 39_996 and np.isin(part, whole).all()


def test_pruning_keeps_what_reaches_the_threshold():
    least = ngram_join.least_matches()
    rng = np.random.default_rng(0)
    trials = rng.random((100_000, ngram_join.HASHES)) < 0.8
    kept = np.ones(len(trials), bool)
    for k, need in enumerate(least):
        kept &= trials[:, :(k + 1) * ngram_join.STEP].sum(axis=1) >= need
    assert kept.all() and least[-1] > 0.5 * ngram_join.HASHES


def test_empty_table(spark):
    assert ngram_join.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_whole_table(spark):
    from commentspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in QUERIES["op9_ngram_jaccard"](spark, sf).collect())
    assert got == brute(rows)
