"""Operator 8 as the query runs it: templates generalise by the documents that have a token at its place."""

from collections import defaultdict

import duckdb
from test_line_dedup import W, corpus, takes_part, tokens_of

from commentspark.llm import line_dedup


def brute(rows):
    """[(id, text)] by following the tree line by line, for rows (id, text) of different ids."""
    mask = lambda t: tuple(W if any(c in "0123456789/\\@" for c in x) or (len(x) >= 8 and not set(x) - set("abcdefABCDEF")) else x for x in t)
    leaves, own = defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for i, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            t = tokens_of(line)
            if takes_part(t):
                own[t].add((i, pos))
                if len(t) >= 4:
                    leaves[len(t), mask(t)[:3]][t].add((i, pos))
    groups = [(places, 2 if len(t) >= 30 or sum(map(len, t)) >= 200 else 3) for t, places in own.items()]
    for lines in leaves.values():
        support, templates = defaultdict(int), defaultdict(set)
        for t, places in lines.items():
            for spot in enumerate(mask(t)):
                support[spot] += len({i for i, _ in places})
        for t, places in lines.items():
            fixed = [x != W and support[at, x] >= 3 for at, x in enumerate(mask(t))]
            if sum(fixed) >= 0.6 * len(t) and sum(fixed[3:]) >= 0.6 * (len(t) - 3):
                templates[tuple(x if f else W for x, f in zip(t, fixed, strict=True))] |= places
        groups += [(places, 3) for places in templates.values()]
    gone = set()
    for places, least in groups:
        docs = {i for i, _ in places}
        if len(docs) >= least:
            gone |= {(i, pos) for i, pos in places if i != min(docs)}
    return [(i, None if text is None else "\n".join(x for pos, x in enumerate(text.split("\n")) if (i, pos) not in gone)) for i, text in rows]


def by_both(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in line_dedup.dedup(docs, by_support=True).collect()), key=lambda r: r[0])
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert got == sorted((r[:2] for r in con.execute(line_dedup.dedup_sql()).fetchall()), key=lambda r: r[0])
    return got


def test_words_that_vary_are_generalised(spark):
    names = ["alice", "bob", "carol", "dave"]
    rows = [(i, f"own words of {n}\nSession opened for user {n} by the root process") for i, n in enumerate(names)]
    assert by_both(spark, rows) == [rows[0]] + [(i, f"own words of {names[i]}") for i in (1, 2, 3)]
    assert line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("n_dropped > 0").count() == 0


def test_prose_with_a_common_opening_stays(spark):
    for texts in (["I went to Paris.", "I went to bed.", "I went to school."], [f"The quick brown {x}." for x in ("fox", "dog", "cat", "hen")],
                  ["Was erlytion that. Oues ereaha.", "Was erlytion that. Are for.", "Was erlytion that. Of. Restwh."]):
        assert by_both(spark, list(enumerate(texts))) == list(enumerate(texts))


def test_against_brute_force_by_support(spark):
    more = [(1000 + i, f"the job {n} was put on the queue of host {i}\n{i} the user {n} has left") for i, n in enumerate(["red", "green", "blue", "red", "red"])]
    rows = corpus(2) + more + [(2000, None), (2001, ""), (2002, "\n\n")]
    assert by_both(spark, rows) == sorted(brute(rows), key=lambda r: r[0])
