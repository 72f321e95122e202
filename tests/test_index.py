"""The incremental index, the run log, file round trips, streaming and topics."""
import pytest
from pyspark.sql import functions as F

from commentspark.operators import index as IX
from commentspark.operators.keywords import bow_vocabulary, tfidf_keywords
from commentspark.operators.qa import append_run_log, recent_runs
from commentspark.operators.topics import fit_topics
from commentspark.plans.fixtures import ENTITY_PATTERNS, LEXICON_A
from commentspark.sources.files import parse_json_column, read_csv, write_csv, write_json
from commentspark.streaming.index_stream import run_stream_index, stream_dedup

ROWS = "video_id string, comment_id string, clean_text string"


def test_ids_stay_text_and_repeats_are_indexed_once(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.createDataFrame([("007", "1", "first"), ("007", "1", "first"), ("1e3", "2", "second"), ("007", "1", "other text"), ("v", None, "x")], ROWS)
    assert tuple(IX.build_index(spark, rows, path).first()) == (4, 2, 2, 0)
    assert sorted((r.id, r.video_id) for r in IX.read_index(spark, path).collect()) == [("comment_007_1", "007"), ("comment_1e3_2", "1e3")]
    more = rows.union(spark.createDataFrame([("n", "9", "new")], ROWS))
    assert tuple(IX.build_index(spark, more, path).first()) == (5, 4, 1, 0)
    assert tuple(IX.build_index(spark, rows.limit(1), path, reset=True).first()) == (1, 0, 1, 0)
    assert [r.id for r in IX.read_index(spark, path).collect()] == ["comment_007_1"]


def test_unreadable_index_is_an_error(spark, tmp_path):
    path = tmp_path / "index"
    path.mkdir()
    (path / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):  # noqa: B017
        IX.build_index(spark, spark.createDataFrame([("v", "1", "t")], ROWS), str(path))


def test_entity_list_is_whole(spark):
    ents = [{"text": f"Name{i} Surname{i}", "label": "PERSON"} for i in range(60)]
    rows = spark.createDataFrame([("v", "1", "t", ents)], ROWS + ", entities array<struct<text:string,label:string>>")
    r = IX.prepare_index_rows(rows).first()
    assert len(r.entities) == 800 and r.entities_truncated and len(r.entity_list) == 60


def test_user_encoder(spark, tmp_path):
    """A worker makes the model once; calls get 64 texts, whatever the Arrow batches' sizes."""
    log = tmp_path / "log"
    log.mkdir()

    def make_model():
        import os
        import uuid
        (log / f"model-{os.getpid()}-{uuid.uuid4().hex}").touch()

        def encode(texts):
            (log / f"call-{len(texts)}-{uuid.uuid4().hex}").touch()
            return [[float(len(t)), 1.0] for t in texts]
        return encode

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        df = spark.range(330).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") != 7, F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("document"))
        out = IX.pandas_encoder(df.coalesce(1), make_model).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r.id: list(r.embedding) for r in out} == {str(i): [float(i if i != 7 else 0), 1.0] for i in range(330)}
    names = [f.name for f in log.iterdir()]
    assert len([n for n in names if n.startswith("model")]) == 1
    assert sorted(int(n.split("-")[1]) for n in names if n.startswith("call")) == [10, 64, 64, 64, 64, 64]
    many = IX.pandas_encoder(df.repartition(12), make_model).collect()
    pids = [f.name.split("-")[1] for f in log.iterdir() if f.name.startswith("model")]
    assert len(many) == 330 and len(pids) - 1 <= len(set(pids)) <= len(pids)  # once per worker and query


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_build_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "index")
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for batch in it:
            seen.add(len(batch))
            yield batch

    rows = spark.range(500).selectExpr("concat('v', id % 7) AS video_id", "cast(id AS string) AS comment_id", "concat('text ', id) AS clean_text")
    rows = rows.mapInPandas(count, rows.schema)
    for added in (500, 0):
        seen.value = 0
        assert tuple(IX.build_index(spark, rows, path, buckets=4).first()) == (500, 500 - added, added, 0)
        assert seen.value == 500


def test_new_rows_meet_the_index_without_moving_it(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.createDataFrame([(f"v{i % 3}", str(i), f"text {i}") for i in range(60)], ROWS)
    IX.build_index(spark, rows, path, buckets=4)
    index = IX.existing_ids(spark, path)
    new = IX.prepare_index_rows(rows).select("id").repartition(4, "id").hint("merge")
    plan = plan_of(new.join(index.hint("merge"), "id", "left_anti"))
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(f"v{i % 9}", str(i), f"text {i}", (i % 21 - 10) / 10, i % 5) for i in range(300)]
    IX.build_index(spark, spark.createDataFrame(rows, ROWS + ", sentiment_polarity double, topic_id int"), path, buckets=2)
    index = IX.read_index(spark, path)
    some = IX.filtered(index, {"sentiment_polarity": {"$lt": -0.1}, "topic_id": 2})
    assert "LessThan(sentiment_polarity,-0.1)" in plan_of(some) and "EqualTo(topic_id,2)" in plan_of(some)
    assert {r.comment_id for r in some.collect()} == {c for _, c, _, p, t in rows if p < -0.1 and t == 2}
    videos = IX.filtered(index, {"video_id": ["v1", "v4"], "sentiment_polarity": {"$gte": 0.5}})
    assert "PartitionFilters: [isnotnull(video_bucket" in plan_of(videos) or "PartitionFilters: [video_bucket" in plan_of(videos)
    assert "In(video_id, [v1,v4])" in plan_of(videos)
    assert {r.comment_id for r in videos.collect()} == {c for v, c, _, p, _ in rows if v in ("v1", "v4") and p >= 0.5}


def test_index_is_opened_by_its_path(spark, tmp_path):
    from commentspark.sources import bucketed

    path = str(tmp_path / "index")
    rows = spark.createDataFrame([(f"v{i % 3}", str(i), f"text {i}") for i in range(40)], ROWS)
    IX.build_index(spark, rows, path, buckets=3)
    other = spark.newSession()
    spark.sql(f"DROP TABLE {bucketed._name(path)}")
    assert IX.read_index(other, path).count() == 40 and bucketed.layout_of(other, path).buckets == 3
    with pytest.raises(ValueError):
        bucketed.create(spark, str(tmp_path), IX.index_layout(2))


def test_run_log_newest(spark, tmp_path):
    path = str(tmp_path / "log")
    runs = spark.range(30).select(F.concat(F.lit("q"), "id").alias("query_id"), F.timestamp_seconds(F.col("id")).alias("start_time"), F.lit("dense").alias("strategy"),
                                  F.lit("a").alias("agent"), F.lit(5).alias("n_results"), F.col("id").alias("num_retrieved"), F.lit(0.5).alias("top_retrieval_distance"),
                                  F.lit(3).alias("response_length"), F.lit(0).alias("answer_is_insufficient"))
    append_run_log(runs.where("id % 2 = 0") if "id" in runs.columns else runs.where("num_retrieved % 2 = 0"), path, "cli")
    append_run_log(runs.where("num_retrieved % 2 = 1"), path, "batch")
    got = [(r.query_id, r.source) for r in recent_runs(spark, path, 3).collect()]
    assert got == [("q29", "batch"), ("q28", "cli"), ("q27", "batch")]


def test_csv_and_json_round_trip(spark, tmp_path):
    rows = [(1, 'a "quoted", text\nwith a line', ["x", "y"]), (2, "", []), (3, "Élan", ["z"])]
    df = spark.createDataFrame(rows, "i long, t string, ks array<string>")
    write_csv(df, str(tmp_path / "csv"))
    back = parse_json_column(read_csv(spark, str(tmp_path / "csv"), "i long, t string, ks string"), "ks", "array<string>")
    assert sorted((r.i, r.t or "", list(r.ks)) for r in back.collect()) == rows
    write_json(df, str(tmp_path / "json"))
    assert sorted((r.i, r.t, list(r.ks)) for r in spark.read.schema(df.schema).json(str(tmp_path / "json")).collect()) == rows


def _comments(spark, n, late=()):
    return spark.createDataFrame([(i, f"v{i % 3}", str(i), None, f"comment {i} thtion", i, f"2024-01-01T{(0 if i in late else 12):02d}:00:{i % 60:02d}Z") for i in range(n)],
                                 "doc_id long, video_id string, comment_id string, author string, comment_text string, likes long, published_at string")


def test_stream_replay_adds_nothing(spark, tmp_path):
    base = str(tmp_path)
    IX.land_pages(_comments(spark, 40), base + "/landing/a", page_size=7)
    run = lambda ckpt: run_stream_index(spark, base + "/landing/*", base + "/index", base + ckpt, LEXICON_A, ENTITY_PATTERNS)
    run("/c1")
    run("/c1")
    run("/c2")  # a lost checkpoint reads everything again
    assert IX.read_index(spark, base + "/index").count() == 40
    IX.land_pages(_comments(spark, 50), base + "/landing/b", page_size=7)
    run("/c1")
    assert IX.read_index(spark, base + "/index").count() == 50


def test_stream_dedup_drops_late_rows(spark, tmp_path):
    base = str(tmp_path)
    IX.land_pages(_comments(spark, 20), base + "/landing/a")
    args = (spark, base + "/landing/*", base + "/out", base + "/ckpt", "1 hour")
    assert stream_dedup(*args).count() == 20
    IX.land_pages(_comments(spark, 25, late={22}), base + "/landing/b")
    ids = [int(r.comment_id) for r in stream_dedup(*args).collect()]
    assert sorted(ids) == [i for i in range(25) if i != 22]


def test_stream_keeps_up_postings(spark, tmp_path):
    """After several landings in small batches, and a repeated batch, BM25 on the maintained postings equals a rebuild."""
    from commentspark.operators import postings as PO

    base = str(tmp_path)
    run = lambda ckpt: run_stream_index(spark, base + "/landing/*", base + "/index", base + ckpt, LEXICON_A, ENTITY_PATTERNS, base + "/bm25", page_files=2)
    IX.land_pages(_comments(spark, 40), base + "/landing/a", page_size=4)
    run("/c1")
    IX.land_pages(_comments(spark, 70), base + "/landing/b", page_size=4)
    run("/c1")
    run("/c2")  # a lost checkpoint: all comments again, as batches of another stream
    kept, index = PO.opened(spark, base + "/bm25"), IX.read_index(spark, base + "/index")
    assert kept.table("docs").count() == kept.table("docs").select("id").distinct().count() == 70
    qs = spark.createDataFrame([("a", "comment 7", None), ("b", "thtion thtion 12", "all"), ("c", "nothing here", None), ("d", "65 comment", None)], "query_id string, query string, pred_key string")
    rebuilt = PO.build(index, base + "/rebuilt", shards=3)
    got, want = ([tuple(r) for r in PO.search(i, qs, 5).orderBy("query_id", "rank").collect()] for i in (kept, rebuilt))
    assert got == want and len(got) == 20
    batch = kept.table("docs").select("batch").first()[0]
    PO.add_batch(kept, index.join(kept.table("docs").where(F.col("batch") == batch).select("id"), "id"), batch)
    assert [tuple(r) for r in PO.search(kept, qs, 5).orderBy("query_id", "rank").collect()] == want


def test_vocabulary_cut_and_topics(spark):
    docs = spark.createDataFrame([(i, " ".join(["river water boat", "engine wheel road"][i % 2].split() * 4)) for i in range(40)], "doc_id long, clean_text string")
    assert [r.term for r in bow_vocabulary(docs, max_features=2, max_df=1.0).orderBy("term_rank").collect()] == ["boat", "engine"]
    assert tfidf_keywords(docs, top_k=2, max_features=3).select("keyword").distinct().count() <= 3
    model = fit_topics(docs, k=2, max_iter=5)
    rows = model.assign(docs).collect()
    assert len(rows) == 40 and all(abs(sum(r.topic_dist) - 1) < 1e-6 and 0 <= r.topic_id < 2 for r in rows)
    assert len({r.topic_id for r in rows if r.id % 2 == 0}) == 1 and model.counter.vocabulary == ["boat", "engine", "river", "road", "water", "wheel"]
    assert model.terms(3).where("rank = 1").count() == 2


def test_saved_topic_model_gives_topics_to_new_comments(spark, tmp_path):
    from commentspark.operators.topics import TopicModel

    docs = spark.createDataFrame([(i, " ".join(["river water boat", "engine wheel road"][i % 2].split() * 4)) for i in range(40)], "doc_id long, clean_text string")
    model = fit_topics(docs, k=2, max_iter=5)
    model.save(str(tmp_path / "model"))
    again = TopicModel.load(spark, str(tmp_path / "model"))
    new = spark.createDataFrame([(100, "a boat on the water"), (101, "wheel of an engine"), (102, "unknown"), (103, "")], "doc_id long, clean_text string")
    found = {r.id: r for r in again.assign(new).collect()}
    topic = {r.id: r.topic_id for r in model.assign(docs).collect()}
    assert found[100].topic_id == topic[0] != topic[1] == found[101].topic_id and len(found) == 4
    assert {(r.topic_id, r.rank, r.term) for r in again.terms().collect()} == {(r.topic_id, r.rank, r.term) for r in model.terms().collect()}
    assert "Exchange" not in plan_of(again.assign(new))


def test_online_topics_are_those_of_spark(spark):
    import numpy as np
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.functions import vector_to_array

    from commentspark.operators import online_lda as O
    from commentspark.operators.topics import tokens_of
    from commentspark.session import materialize

    words = [f"w{i:02d}" for i in range(60)]
    rows = [(i, " ".join(words[(i % 3 * 20 + i * j * j) % 60] for j in range(i % 37 * (9 if i % 50 == 7 else 1)))) for i in range(200)]
    docs = materialize(spark.createDataFrame(rows, "doc_id long, clean_text string").repartition(3, "doc_id").sortWithinPartitions("doc_id"), "lda-test")
    tokens = tokens_of(docs, "doc_id", "clean_text")
    counted = O.count_vectors(tokens, words)
    found = O.fit_online(counted, len(words), 4, 6, 42)
    vectors = CountVectorizerModel.from_vocabulary(words, inputCol="tokens", outputCol="features").transform(tokens)
    want = LDA(k=4, maxIter=6, seed=42, optimizer="online", subsamplingRate=1.0, optimizeDocConcentration=False, topicDistributionCol="dist").fit(vectors)
    np.testing.assert_allclose(found.weights, want.topicsMatrix().toArray().T, rtol=1e-5)
    dist = {r.id: r.d for r in want.transform(vectors).select("id", vector_to_array("dist").alias("d")).collect()}
    mine = {r.id: r.topic_dist for r in found.distributions(counted).collect()}
    # A document between two topics may end at either: Spark's model starts its inference elsewhere.
    assert mine.keys() == dist.keys() and np.mean([np.allclose(mine[i], dist[i], atol=5e-3) for i in dist]) > 0.8
    assert all(mine[r.id] == [0.0] * 4 for r in counted.where("size(ids) = 0").collect())
    assert [(t, w) for t, _, w, _ in found.top_terms(3)] == [(r.topic, w) for r in want.describeTopics(3).orderBy("topic").collect() for w in r.termIndices]


def test_documents_are_inferred_alike_in_any_company(monkeypatch):
    import numpy as np

    from commentspark.operators import online_lda as O

    rng = np.random.default_rng(5)
    size = rng.integers(1, 60, 90)
    ids = np.concatenate([np.sort(rng.choice(80, n, replace=False)) for n in size])
    counts = rng.integers(1, 9, len(ids)).astype(float)
    beta, start = O.exp_expectation(rng.gamma(2.0, 0.5, (5, 80))).T.copy(), rng.gamma(100.0, 0.01, 5)
    ends = np.cumsum(size)
    alone = [O.infer(ids[e - n:e], counts[e - n:e], size[i:i + 1], beta, start, 0.2) for i, (e, n) in enumerate(zip(ends, size))]
    for terms in (1, 200, 1 << 15):
        monkeypatch.setattr(O, "GROUP_TERMS", terms)
        for got, want in zip(O.infer(ids, counts, size, beta, start, 0.2), zip(*alone)):
            np.testing.assert_allclose(got, np.concatenate(want), rtol=1e-8)
    monkeypatch.setattr(O, "HELD_TERMS", 7)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"ids": pa.array([[1] * n for n in (3, 0, 9, 4, 4, 0)], pa.list_(pa.int32()))})
    held = [[len(x) for x in t.column("ids").to_pylist()] for t in O._held(iter([batch, batch]))]
    assert sum(held, []) == [3, 0, 9, 4, 4, 0] * 2 and max(map(sum, held)) <= 9


def test_token_stats_are_those_of_counted_terms(spark):
    from commentspark.functions.text import term_counts
    from commentspark.operators import keywords as K

    tokens = spark.createDataFrame([(i, ["a", "b"] * (i % 3) + ["c"] * (i % 2) + ["é"]) for i in range(20)] + [(99, []), (100, None)], "id long, tokens array<string>")
    counted = tokens.select(term_counts(F.col("tokens")).alias("counts"))
    got, want = ([tuple(r) for r in v.orderBy("term_rank").collect()] for v in (K.vocabulary_of_tokens(tokens, 3, 2, 0.95), K.vocabulary(counted, 3, 2, 0.95)))
    assert got == want and len(got) == 3


def test_text_is_not_shuffled_for_keywords(spark):
    from commentspark.operators import keywords as K

    docs = spark.createDataFrame([(i, f"alpha beta beta word{i % 4}") for i in range(30)], "doc_id long, clean_text string").repartition(5)
    counted = K.term_counts(docs, "doc_id", "clean_text", bigrams=True)
    assert sorted((c["term"], c["tf"]) for c in counted.where("id = 3").first().counts) == sorted(
        {"alpha": 1, "beta": 2, "word3": 1, "alpha beta": 1, "beta beta": 1, "beta word3": 1}.items())
    plan = plan_of(K.vocabulary(counted, 5, 2))
    assert plan.count("Exchange hashpartitioning(term") == 1 and plan.count("Exchange hashpartitioning") == 1
    best = {(r.id, r.keyword): r.weight for r in tfidf_keywords(docs, top_k=9).collect()}
    assert abs(sum(w * w for (i, _), w in best.items() if i == 3) - 1) < 1e-9


def test_sketches_merge(spark, tmp_path):
    from commentspark.operators import sketches as SK

    df = spark.range(40_000).selectExpr("id % 3 AS g", "id % 9000 AS item")
    for part in range(4):
        SK.keep(SK.sketched(df.where(f"item % 4 = {part}"), ["g"], F.col("item")), str(tmp_path / "s"))
    kept = SK.kept(spark, str(tmp_path / "s"))
    total = SK.merged(kept, []).first()
    assert total.n == 40_000 and abs(total.n_distinct - 9000) <= SK.error_bound() * 9000
    for r in SK.merged(kept, ["g"]).collect():
        assert abs(r.n_distinct - 3000) <= SK.error_bound() * 3000


def test_typed_entities_are_not_parsed(spark):
    """A list of entities becomes what its JSON does, without being parsed again."""
    rows = [("v", str(i), "text", e) for i, e in enumerate([None, [], [("a \"b\"\n\\é😀", "PERSON")], [("x" * 900, None), None, (None, "GPE")]])]
    typed = spark.createDataFrame(rows, "video_id string, comment_id string, clean_text string, entities array<struct<text:string,label:string>>")
    out = IX.prepare_index_rows(typed)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "JsonToStructs" not in plan
    parsed = IX.prepare_index_rows(typed.withColumn("entities", F.to_json("entities")))
    assert "from_json" in parsed._jdf.queryExecution().optimizedPlan().toString()
    order = lambda df: sorted(df.select("id", "entities", "entity_list", "entities_truncated").collect(), key=lambda r: r.id)
    assert order(out) == order(parsed)
