import itertools
import math
import random

import numpy as np
import public_tokenizers as P
import pytest

from commentspark.llm import langid

VOCAB = P.path("piece_bpe_32k.model")


def segmentations(word, model):
    """Every segmentation, listed."""
    if not word:
        yield []
    for j in range(1, len(word) + 1):
        k = model.index.get(word[:j])
        if k is None and j == 1:
            k = -1
        if k is not None:
            for rest in segmentations(word[j:], model):
                yield [k, *rest]


@pytest.fixture(scope="module")
def toy():
    rng = np.random.default_rng(3)
    index = {p: i for i, p in enumerate(["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "c"])}
    prob = rng.random((len(index), 2))
    return langid.Model(["x", "y"], index, prob / prob.sum(axis=0))


@pytest.mark.parametrize("word", ["a", "ab", "abab", "babac", "azb", "abaabac"])
def test_forward_sums_all_segmentations(toy, word):
    value = lambda s, lang: math.prod(toy.prob[k, lang] if k >= 0 else langid.UNKNOWN for k in s)
    for lang in (0, 1):
        every = [(s, value(s, lang)) for s in segmentations(langid.MARK + word, toy)]
        total = sum(v for _, v in every)
        assert math.isclose(langid.log_likelihoods(word, toy)[lang], math.log(total), rel_tol=1e-9)
        want = np.zeros(len(toy.index))
        for s, v in every:
            for k in s:
                if k >= 0:
                    want[k] += v / total
        got = np.zeros(len(toy.index))
        for k, use in langid.expected_uses(word, toy, lang):
            got[k] += use
        assert np.allclose(got, want)


def test_many_words_at_a_time(toy):
    rng = random.Random(0)
    words = ["".join(rng.choices("abcz", k=rng.randint(1, 40))) for _ in range(300)] + ["日本語", "é"]
    got = langid.many_log_likelihoods(words, toy, langid.PieceTable(toy))
    assert np.allclose(got, [langid.log_likelihoods(w, toy) for w in words])


def test_long_word_keeps_its_value(toy):
    long = "ab" * 4000
    assert all(map(math.isfinite, langid.log_likelihoods(long, toy)))
    assert math.isfinite(sum(u for _, u in langid.expected_uses(long, toy, 0)))


def test_odd_rows(spark):
    rng = random.Random(1)
    en = [" ".join(rng.choices("the and of water house green".split(), k=30)) for _ in range(40)]
    fr = [" ".join(rng.choices("le la maison verte eau chien".split(), k=30)) for _ in range(40)]
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(itertools.chain(zip(en, itertools.repeat("en")), zip(fr, itertools.repeat("fr"))))]
    odd = [(900, None, "en", "x"), (901, "", None, "x"), (902, "1234 !! 55", "fr", "x"), (903, "THE HOUSE of Water", None, "x"), (None, "la maison", None, None),
           (903, "THE HOUSE of Water", None, "x"), (904, "a" * 200_000, None, "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = langid.train(docs.filter(~langid.held_out()), VOCAB)
    got = langid.classify(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[900].score == 0
    assert by[903].lang_pred == "en" and by[None].lang_pred == "fr"
    assert all(by[i].lang_pred == lang for i, _, lang, _ in rows) and all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    got = langid.classify(docs, langid.train(docs, VOCAB)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert langid.classify(docs.limit(0), langid.train(docs.limit(0), VOCAB)).count() == 0


def test_held_out_accuracy(spark):
    from commentspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_language_id"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    right = [r.lang_pred == r.lang for r in got if r.lang]
    assert len(right) > 100 and sum(right) / len(right) >= 0.97
