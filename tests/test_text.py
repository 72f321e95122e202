"""Cleaning and tokenizing of Unicode text, against expected strings written by hand."""
from pyspark.sql import functions as F

from commentspark.functions import text as T

# (text, cleaned, whitespace tokens, vectorizer tokens)
SAMPLES = [
    ("Hi there http://x.y/z?q=1 ok", "Hi there ok", ["hi", "there", "ok"], ["hi", "there", "http", "ok"]),
    ("Caf\xe9 na\xefve é x", "Caf\xe9 na\xefve e x", ["caf\xe9", "na\xefve", "e", "x"], ["caf\xe9", "na\xefve"]),
    ("x\xb2 Ⅻ ⅻ \xb3", "x\xb2 Ⅻ ⅻ \xb3", ["x\xb2", "ⅻ", "ⅻ", "\xb3"], ["x\xb2"]),
    ("a​b", "ab", ["ab"], []),
    ("a\xa0b", "a b", ["a", "b"], []),
    ("a\x0bb\x1cc\x85d", "a b c d", ["a", "b", "c", "d"], []),
    ("“curly” ‘q’", "curly q", ["curly", "q"], ["curly"]),
    ("HTTP://UP.com httpfoo bar", "HTTPUP.com bar", ["httpup.com", "bar"], ["http", "up", "com", "httpfoo", "bar"]),
    ("中文 \U0001f600 ٣", "中文 ٣", ["中文", "٣"], ["中文"]),
    ("  lead trail  ", "lead trail", ["lead", "trail"], ["lead", "trail"]),
    ("don't -- stop!?", "don't -- stop!?", ["don't", "--", "stop!?"], ["don", "stop"]),
    ("", "", [], []),
]


def test_clean_and_tokens(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SAMPLES)], "i int, t string")
    rows = df.select("i", T.clean_text("t").alias("c"), T.ws_tokens(T.clean_text("t")).alias("w"),
                     T.ml_tokens("t").alias("m")).collect()
    for r in rows:
        assert (r.c, list(r.w), list(r.m)) == SAMPLES[r.i][1:]


def test_bigrams_after_stop_words(spark):
    df = spark.createDataFrame([("the cat and the big dog",)], "t string")
    r = df.select(T.uni_and_bigrams(T.remove_stop_words(T.ml_tokens("t"))).alias("g")).first()
    assert list(r.g) == ["cat", "big", "dog", "cat big", "big dog"]


def test_stop_words_are_those_of_spark_ml(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(T.default_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_custom_stop_words(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>")
    assert df.select(T.remove_stop_words(F.col("t"), ("b",)).alias("g")).first().g == ["a", "c"]


def test_nonblank_is_what_strip_leaves(spark):
    from pyspark.sql import functions as F

    from commentspark.functions import text as T

    rows = [(t,) for t in (None, "", " ", "\n", " \t\x0b\x1c\x1f\x85 　", " a ", "\n.\n", "​", "\x00", "\U0001f600", "a\n")]
    df = spark.createDataFrame(rows, "t string")
    out = df.select("t", T.is_nonblank("t").alias("is"), F.coalesce(T.strip_ws("t") != "", F.lit(False)).alias("due"))
    assert all(r["is"] == r.due for r in out.collect())
    assert "regexp_replace" not in out.select("is")._jdf.queryExecution().optimizedPlan().toString()
