import math

import numpy as np
import pytest

from commentspark.llm import embed_dedup
from commentspark.llm.components import connected_components


def brute(rows, threshold):
    """n_links and component of each row position."""
    ok = [v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    n, links = len(rows), []
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links.append((i, j))
    root, count = list(range(n)), [0] * n
    find = lambda x: x if root[x] == x else find(root[x])
    for i, j in links:
        count[i] += 1
        count[j] += 1
        root[find(i)] = find(j)
    low = {}
    for i, (vid, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), vid), vid)
    return sorted((vid, count[i], low[find(i)], vid == low[find(i)]) for i, (vid, _) in enumerate(rows))


def clustered(seed, n=220, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((25, d))
    out = [(k * 3, [float(x) for x in centres[rng.integers(25)] + rng.standard_normal(d) * rng.choice([0.0, 0.05, 0.25])]) for k in range(n)]
    return out


@pytest.mark.parametrize("block", [1_024, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    nan, inf = float("nan"), float("inf")
    odd = [(2000, None), (2001, []), (2002, [0.0] * 12), (2003, [None] + [1.0] * 11), (2004, [nan] * 12), (2005, [inf] * 12), (2006, [1.0, 2.0]), (2007, [1.0, 2.0]),
           (2008, [-0.0, 1.0]), (2009, [0.0, 1.0]), (7, clustered(5)[0][1])]
    rows = clustered(5) + odd
    df = spark.createDataFrame([(a, b, a) for a, b in rows], "vec_id long, embedding array<double>, n_links long")
    got = embed_dedup.near_duplicates(df)
    assert sorted(map(tuple, got.collect())) == brute(rows, 0.9)


def test_repeated_rows_and_empty(spark):
    rows = [(1, [1.0, 0.0])] * 3 + [(9, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, embed_dedup.near_duplicates(df).collect())) == [(1, 2, 1, True)] * 3 + [(9, 0, 9, True)]
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (5, 5), (300, 300), (None, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()))
    assert got == {i: 0 for i in range(61)} | {100: 100, 150: 100, 200: 100}


def test_query_whole_table(spark):
    from commentspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op7_embedding_near_dedup"](spark, sf).collect())) == brute(rows, 0.9)
