"""A batch of postings is written where its documents' shard lies."""
from pyspark.sql import functions as F

from commentspark.operators import postings as PO


def test_no_posting_is_shuffled(spark, tmp_path, monkeypatch):
    written = {}
    plain = PO.bucketed.append

    def noted(df, path, overwrite_partitions=False):
        written[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().executedPlan().toString()
        plain(df, path, overwrite_partitions)

    monkeypatch.setattr(PO.bucketed, "append", noted)
    docs = spark.createDataFrame([(f"d{i:03d}", f"alpha w{i % 7} w{i % 5}", ["all", "neg"] if i % 3 else ["all"]) for i in range(200)],
                                 "id string, document string, pred_keys array<string>")
    index = PO.build(docs, str(tmp_path / "bm25"), shards=4)
    assert "Exchange" not in written["postings"] and "Exchange" not in written["docs"]
    assert "Bucketed: true" in written["postings"] and "keys" not in index.table("postings").columns
    got = {(r.term, r.pred_key): r.df for r in index.table("terms").groupBy("term", "pred_key").agg(F.sum("df").alias("df")).collect()}
    assert got["alpha", "all"] == 200 and got["alpha", "neg"] == 133 and got["w6", "all"] == len([i for i in range(200) if i % 7 == 6])
    assert index.table("postings").count() == sum(len({"alpha", f"w{i % 7}", f"w{i % 5}"}) for i in range(200))


def test_template_is_the_masked_line(spark):
    from commentspark.llm import line_dedup

    lines = spark.createDataFrame([("user u1 logged in from far away",)], "line string")
    out = line_dedup._parsed(lines, line_dedup.DEPTH, line_dedup.CONSTANT)
    assert out.where(F.col("template") == F.xxhash64(F.lit("masked"), "masked")).count() == 1
