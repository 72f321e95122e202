import random
import re
from collections import defaultdict

import duckdb

from commentspark.llm import line_dedup

W = line_dedup.WILDCARD


def takes_part(t):
    return len(t) >= 4 or sum(map(len, t)) >= 20


def tokens_of(line):
    return tuple(re.sub("[\\s\x85]+", " ", line).strip(" ").split(" ")) if line.strip() else ()


def brute(rows):
    """[(id, text)] by walking the tree line by line; rows are (id, text)."""
    def mask(t):
        return W if re.search(r"[0-9/\\@]", t) or re.fullmatch("[A-Fa-f]{8,}", t) else t

    tree, equal = defaultdict(set), defaultdict(set)
    for doc in {r for r in rows if r[1] is not None}:
        for pos, line in enumerate(doc[1].split("\n")):
            t = tokens_of(line)
            if takes_part(t):
                path = tuple(map(mask, t))
                words, rest = [x for x in path if x != W], [x for x in path[3:] if x != W]
                general = len(t) >= 4 and len(words) >= 0.6 * len(t) and len(rest) >= 0.6 * (len(t) - 3)
                tree[path if general else ("own", *t)].add((doc, pos))
                equal[t].add((doc, pos))
    order = lambda d: (d[0] is not None, d[0] or 0)
    gone, settled = set(), set()

    def drop(places, least):
        docs = {d for d, _ in places}
        if len(docs) >= least:
            first = min(docs, key=order)
            gone.update((d, pos) for d, pos in places - settled if d != first)
            settled.update(places)

    for places in tree.values():
        drop(places, 3)
    for t, places in equal.items():
        drop(places, 2 if len(t) >= 30 or sum(map(len, t)) >= 200 else 3)
    return [(i, None if t is None else "\n".join(x for pos, x in enumerate(t.split("\n")) if ((i, t), pos) not in gone)) for i, t in rows]


def corpus(seed):
    rng = random.Random(seed)
    words = [f"word{c}" for c in "abcdefghijklmnop"] + ["x1", "2024", "7", "a/b", "deadbeef", "facade", "<*>"]
    shared = [" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(30)]
    rows = []
    for k in range(150):
        lines = []
        for _ in range(rng.randint(1, 8)):
            t = rng.choice(shared).split(" ") if rng.random() < 0.6 else rng.choices(words, k=rng.randint(1, 9))
            if rng.random() < 0.3:
                t[-1] = rng.choice(words)
            lines.append(rng.choice([" ", "  ", " \t", "\u00a0", "\u3000 "]).join(t))
        rows.append((k * 5, "\n".join(lines)))
    return rows


def test_against_brute_force(spark):
    long = "\n".join(f"user {i} logged in from host h{i}" for i in range(3000))
    rows = corpus(2) + [(900, None), (901, ""), (902, "\n\n"), (903, long), (904, long), (905, long), (906, "one two three four"), (906, "one two three four"), (906, corpus(2)[0][1]),
                        (None, corpus(2)[1][1]), (907, "z" * 200_000 + " one two three"), (908, " ".join(["y" * 100_000] * 5))]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, n_lines int, d int")
    got = line_dedup.dedup(df)
    assert got.columns == ["doc_id", "text", "n_lines", "d", "n_lines_", "n_dropped"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(brute(rows), key=key)


def test_variable_fields(spark):
    rows = [(i, f"own text {i}\nSession {i * 17} opened for user u{i} by root") for i in range(10)]
    got = {r.doc_id: r.text for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"own text {i}" for i in range(1, 10))


def deduped(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in line_dedup.dedup(docs).orderBy("doc_id").collect()]


def test_prose_with_a_common_opening_stays(spark):
    for texts in (["I went to Paris.", "I went to bed.", "I went to school."], [f"The quick brown {x}." for x in ("fox", "dog", "cat", "hen")],
                  ["12 34 56 total"] + ["98 76 54 total", "1 2 3 total"]):
        assert deduped(spark, texts) == texts


def test_long_lines_of_two_documents_and_lines_without_spaces(spark):
    long, short, chinese = " ".join(f"word{'abcdefghij'[k % 10]}" for k in range(60)), "one two three four", "\u8fd9\u662f\u4e00\u4e2a\u91cd\u590d\u7684\u884c" * 4
    assert deduped(spark, [f"{long}\nx", f"{short}\n{long}", f"{short}\ny"]) == [f"{long}\nx", short, f"{short}\ny"]
    assert deduped(spark, [f"{chinese}\n{k}" for k in range(3)]) == [f"{chinese}\n0", "1", "2"]
    assert deduped(spark, ["a b\u00a0c d\nx", "a\u3000b c d\ny", "a b c\u2003d\nz"]) == ["a b\u00a0c d\nx", "y", "z"]


def test_empty_table(spark):
    assert line_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_sql(spark):
    from commentspark.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(ORACLE["op8_line_dedup"]).fetchall())
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in QUERIES["op8_line_dedup"](spark, sf).collect())
    assert got == want and sum(r[3] for r in got) > 100
