import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from commentspark.llm import divergence

ROWS = "doc_id long, text string, lang string, source string"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute(rows, min_docs=divergence.MIN_DOCS, top=divergence.TOP):
    """The audit by its definition, on plain dictionaries; rows are (id, text, lang, source)."""
    fold = str.maketrans(UPPER, UPPER.lower())
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(fold))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        def shares(count, kept=kept):
            whole = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // whole for t in kept}
        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(terms)[:top], 1)}
    return out


def corpus(seed, n=160):
    rng = random.Random(seed)
    words = ["the", "Café", "ÉTÉ", "naïve", "日本", "x", "word", "İz"] + [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(60)]
    rows = []
    for k in range(n):
        near = words[:: rng.randint(1, 4)]
        text = rng.choice([None, "", "12 34", *[" ".join(rng.choices(near, k=rng.randint(1, 30))) for _ in range(9)]])
        rows.append((k, text and text.replace("w", rng.choice("wW")).replace(" ", rng.choice([" ", "7", "_", "\x00", " "]), 3), rng.choice(["en", "de", None, ""]), rng.choice([None, "", "a", "b", "Zoë", "z"])))
    return rows + rows[:20] + [(1000, "alone", "fr", "a"), (1001, None, "it", "b"), (1002, "", "it", "c")]


def collected(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("bits", [64, 4])
def test_against_brute_force(spark, bits):
    """With digests of four bits nearly every digest stands for several terms."""
    rows = corpus(bits)
    got = collected(divergence.audit(spark.createDataFrame(rows, ROWS).repartition(7), digest_bits=bits))
    assert got == brute(rows)


def test_flushed_dictionaries_blocks_and_long_text(spark, monkeypatch):
    rows = corpus(5, 60) + [(2000, "the word " * 300_000 + "x" * 2_000_000, "en", "a")]
    for name, value in {"BLOCK_TERMS": 3, "BLOCK_SOURCES": 2, "STEP": 2, "ENTRIES": 20, "SLICE": 1000}.items():
        monkeypatch.setattr(divergence, name, value)
    assert collected(divergence.audit(spark.createDataFrame(rows, ROWS).repartition(3), min_docs=2, top=4)) == brute(rows, 2, 4)


def test_sql(spark):
    rows = [r for r in corpus(9) if not r[1] or "\x00" not in r[1]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    assert set(con.execute(divergence.audit_sql()).fetchall()) == brute(rows)


def test_share_is_exact(spark):
    from pyspark.sql import functions as F

    rows = [(0, 1, 0), (0, 0, 1), (9_000_000_000_000, 9_000_000_000_001, 17), (123_456_789_012, 999_999_999_999_999, 7_654_321), (5, 5, 1)]
    df = spark.createDataFrame(rows, "n long, total long, terms long").withColumn("p", divergence._share(F.col("n"), F.col("total"), F.col("terms")))
    for n, total, terms, p in df.collect():
        if n <= total:
            assert p == 1 + 1_000_000_000 * (n + 2) // (total + 2 * terms)


def test_empty_and_clashing_columns(spark):
    assert divergence.audit(spark.createDataFrame([], ROWS)).count() == 0
    rows = corpus(3, 40)
    wide = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], ROWS + ", n long, g long, digest long, term string")
    assert collected(divergence.audit(wide, min_docs=2)) == brute(rows, 2)
