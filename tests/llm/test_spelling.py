import random
import re
import zlib
from collections import Counter

import numpy as np

from commentspark.llm import spelling

ROWS = "doc_id long, text string"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(rows):
    """{word: n} by the definition, on strings."""
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, UPPER.lower()))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    words = words_of(rows)
    forms, near = {}, {}
    for w, n in words.items():
        others = [o for o in words if is_near(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, near[w], words[forms[w]] if forms[w] else None))
    return out


def corpus(seed, n=300):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdé", k=rng.randint(4, 8))) for _ in range(40)] + ["straße", "ÀÉÎÕÜ", "aaaaa", "aaaaaa", "aaaaaaa", "abababab", "bababab"]
    rows = []
    for k in range(n):
        found = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(stems[: rng.randint(1, len(stems))])
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "x", "b", w[at] + "e"]) + w[at + rng.randint(0, 1):]
            found.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((rng.choice([k, k, k, None]), rng.choice([" ", "-", "\n", "日", "İ"]).join(found) if rng.random() < 0.95 else None))
    return rows + rows[:30]


def collected(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_against_brute_force(spark):
    rows = corpus(1)
    want = brute(rows)
    assert sum(w[1] is not None for w in want) > 50 and any(w[1] != w[2] for w in want if w[1])
    assert collected(spelling.variants(spark.createDataFrame(rows, ROWS).repartition(5))) == want


def test_blocks_flushes_and_long_texts(spark, monkeypatch):
    rows = corpus(2, 120) + [(k, "mistletoe " * 150_000 + "q" * (3_000 + k % 2)) for k in range(7)]
    for name, value in {"BLOCK": 3, "ENTRIES": 10, "SLICE": 100}.items():
        monkeypatch.setattr(spelling, name, value)
    assert collected(spelling.variants(spark.createDataFrame(rows, ROWS).repartition(3))) == brute(rows)


def test_bitsets_against_definition():
    rng = random.Random(7)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(150)})
    width = max(map(len, words)) + 2
    letters = np.array([list(w.encode().ljust(width, b"\0")) for w in words], np.uint8)
    lengths = np.array([len(w) for w in words])
    near = spelling.near_matrix(letters, lengths, letters, lengths)
    found = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little", count=len(words))
    assert all(found[i, j] == is_near(a, b) for i, a in enumerate(words) for j, b in enumerate(words))


def test_long_chain_of_forms(spark):
    chain, n = [("a" * (5 + k), "a" * (6 + k)) for k in range(40)], 41
    got = dict(spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert len(got) == n - 1 and set(got.values()) == {"a" * 45}


def test_empty_and_clashing_columns(spark):
    assert spelling.variants(spark.createDataFrame([], ROWS)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, ""), (3, "a bc 12")], ROWS)).count() == 0
    rows = corpus(4, 60)
    wide = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], ROWS + ", n long, word string, id long")
    assert collected(spelling.variants(wide)) == brute(rows)
