"""Texts are cleaned, tokenised and encoded once per row, whatever is derived from them."""
import hashlib
import math
import re

from pyspark.sql import functions as F

from commentspark.functions import text as T
from commentspark.operators.entities import extract_entities
from commentspark.operators.index import hashing_encoder
from commentspark.operators.keywords import tfidf_keywords
from commentspark.operators.sentiment import score_sentiment
from commentspark.plans.fixtures import ENTITY_PATTERNS, LEXICON_A

TEXTS = ["thtion attion http://x.y z", None, "  \t", "@@", "mail me: a.b@c.de now", "ertion eriner x thtion"]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, comment_text string")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cleaned_once(spark):
    rows = T.with_clean_text(docs(spark))
    rows = score_sentiment(rows, "clean_text", LEXICON_A).withColumn("entities", extract_entities(F.col("clean_text"), ENTITY_PATTERNS))
    plan = plan_of(rows.select("doc_id", "sentiment_polarity", "sentiment_subjectivity", "entities"))
    assert plan.count("http[^") == 1 and plan.count("]{2,}") == 1
    got = {r.doc_id: (r.clean_text, r.sentiment_polarity, r.sentiment_subjectivity) for r in rows.collect()}
    assert got == {0: ("thtion attion z", 0.5, 0.65), 4: ("mail me a.bc.de now", 0.0, 0.0), 5: ("ertion eriner x thtion", -0.1, 0.7)}


def test_addresses_are_found_in_texts_with_an_at_sign(spark):
    found = docs(spark).select(extract_entities(F.col("comment_text"), ENTITY_PATTERNS[:1]).alias("e")).collect()
    assert [None if r.e is None else [e.text for e in r.e] for r in found] == [[], None, [], [], ["a.b@c.de"], []]
    plain = docs(spark).select(extract_entities(F.col("comment_text"), [("X", "a|[a-z]+@[a-z]+", 0)]).alias("e")).collect()
    assert plain[5].e == [] and plain[0].e[0].text == "a"  # an alternative without one


def test_encoder(spark):
    got = {r.doc_id: r.embedding for r in hashing_encoder(docs(spark), "comment_text").collect()}
    for i, text in enumerate(TEXTS):
        counts = [0] * 64
        for t in re.findall(r"\w{2,}", (text or "").lower()):
            counts[int(hashlib.md5(t.encode()).hexdigest()[:2], 16) // 4] += 1
        norm = math.sqrt(sum(x * x for x in counts)) or 1.0
        assert all(abs(a - x / norm) < 1e-7 for a, x in zip(got[i], counts, strict=True))


def test_keywords_against_brute_force(spark):
    import random

    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(120)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, clean_text string")
    counts = []
    for t in texts:
        tokens = [w for w in t.split() if len(w) > 1]
        grams = tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]
        counts.append({g: grams.count(g) for g in grams})
    df = {}
    for c in counts:
        for g in c:
            df[g] = df.get(g, 0) + 1
    cf = {g: sum(c.get(g, 0) for c in counts) for g, n in df.items() if n >= 2}
    vocab = set(sorted(cf, key=lambda g: (-cf[g], g))[:200])
    want = {}
    for i, c in enumerate(counts):
        raw = {g: n * (math.log(121 / (1 + df[g])) + 1) for g, n in c.items() if g in vocab}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        for k, g in enumerate(sorted(raw, key=lambda g: (-round(raw[g], 9), g))[:5], 1):
            want[i, k] = (g, raw[g] / norm)
    found = tfidf_keywords(rows, top_k=5, max_features=200)
    got = {(r.id, r["rank"]): (r.keyword, r.weight) for r in found.collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    assert "Join" not in plan_of(found)
