"""Predicates, sentiment thresholds, kappa, sanitiser, conform."""
import pytest
from pyspark.sql import functions as F

from commentspark.functions.predicates import compile_where, dashboard_condition, route_query
from commentspark.functions.scalars import safe_int, sanitize_json_list
from commentspark.operators.evaluation import agreement_stats
from commentspark.operators.index import conform
from commentspark.operators.sentiment import sentiment_label


def test_where_compiler(spark):
    df = spark.createDataFrame([(1, -0.2, 3), (2, None, 3), (3, 0.5, 2)], "id int, p double, t int")
    w = compile_where({"p": {"$lt": -0.1}, "t": 3})
    assert [r.id for r in df.where(w).collect()] == [1]
    with pytest.raises(ValueError):
        compile_where({"p": {"$near": 1}})


def test_dashboard_condition(spark):
    df = spark.createDataFrame([("x", -0.2, 3), ("y", None, 3), ("z", 0.5, 2), (None, 0.0, None)], "video_id string, sentiment_polarity double, topic_id int")
    kept = lambda *controls: df.where(dashboard_condition(*controls)).count()
    assert [kept(), kept(["x", "z"]), kept([], (-0.5, 0.1)), kept((), (-1.0, 1.0), "Topic 3"), kept(["y"], (-0.5, 1.0))] == [4, 2, 2, 2, 0]


def test_labels_at_threshold(spark):
    df = spark.createDataFrame([(0.1,), (-0.1,), (0.1000001,), (-0.2,)], "p double")
    assert [r.l for r in df.select(sentiment_label(F.col("p")).alias("l")).collect()] == \
        ["neutral", "neutral", "positive", "negative"]


def test_router(spark):
    qs = ["Summarize negative sentiment", "Which product is mentioned?", "What about topic 3?", "Show pain points"]
    df = spark.createDataFrame([(q,) for q in qs], "q string")
    assert [r.a for r in df.select(route_query(F.col("q")).alias("a")).collect()] == \
        ["sentiment_summary", "entity_query", "topic_query", "general_qa"]


def test_kappa_null_when_full_agreement_on_one_label(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a")], "x string, y string")
    r = agreement_stats(df, "x", "y").first()
    assert r.agreement_rate == 1.0 and r.kappa is None


def test_sanitiser_and_safe_int(spark):
    df = spark.createDataFrame([("not json",), ("{}",), ('[{"text":"A","label":"ORG"}]',)], "r string")
    assert [r.s for r in df.select(sanitize_json_list(F.col("r")).alias("s")).collect()] == \
        ["[]", "[]", '[{"text":"A","label":"ORG"}]']
    df2 = spark.createDataFrame([("3.0", 2.7), ("7", float("nan"))], "s string, d double")
    r = df2.select(safe_int(F.col("s")).alias("a"), safe_int(F.col("d")).alias("b")).collect()
    assert [(x.a, x.b) for x in r] == [(-1, 2), (7, -1)]


def test_conform(spark):
    df = spark.createDataFrame([("v", "c", "t")], "video_id string, comment_id string, clean_text string")
    out = conform(df)
    assert {"topic_id", "entities", "sentiment_polarity"} <= set(out.columns)
    with pytest.raises(ValueError):
        conform(df.drop("clean_text"))


def test_blank_and_incomplete_rows_go(spark):
    from commentspark.functions import text as T
    from commentspark.operators.index import prepare_index_rows

    df = spark.createDataFrame([(0, None), (1, ""), (2, "  　\t"), (3, "http://only.a/link"), (4, "@#%"), (5, " kept ")], "id long, text string")
    clean = df.withColumn("text", T.clean_text(T.fill_text("text")))
    assert [(r.id, r.text) for r in clean.where(T.is_nonblank("text")).collect()] == [(5, "kept")]
    rows = [("v", "1", "text"), (None, "2", "text"), (" ", "3", "text"), ("v", "", "text"), ("v", None, "text"), ("v", "6", "  "), ("v", "7", None)]
    out = prepare_index_rows(spark.createDataFrame(rows, "video_id string, comment_id string, clean_text string"))
    assert [r.id for r in out.collect()] == ["comment_v_1"]
