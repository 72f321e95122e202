import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from commentspark.llm import mixing

ROWS = "doc_id long, text string, source string"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(rows):
    """{source: target} by sharing again, source by source, on fractions."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, out, free = Fraction(3, 2) * sum(sizes.values()), {}, set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[o] for o in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return sizes, out | share
        for s in over:
            out[s] = Fraction(2 * sizes[s])
            left -= out[s]
        free -= over
    return sizes, out


def corpus(seed, n=600, sources=("a", "b", "B", "é", "zz", None)):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = rng.choice([0, 1, 2, 5, 20, 20, 40, 90, rng.randint(1, 400)])
        rows.append((k, rng.choice([" ", "\t\n", "\x0b", "  "]).join(rng.choices(["x", "yy", " z", "日本"], k=words)) + rng.choice(["", " "]), rng.choices(sources, [1, 30, 8, 8, 4, 2][:len(sources)])[0]))
    return rows


def checked(got, rows, slack):
    """What the contract says of every row and source; returns how far each source is from its target."""
    sizes, goals = targets(rows)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size(t)) for i, t, _ in rows)
    source = defaultdict(set)
    for i, _, s in rows:
        source[i].add(s)
    taken, number = Counter(), Counter()
    for r in got:
        s, = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(float(goals[s]))
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        number[s] += r.copies
    for s, n in Counter(s for _, _, s in rows).items():
        assert abs(taken[s] - goals[s]) <= slack, (s, taken[s], goals[s])
        if sizes[s]:
            assert abs(number[s] - n * goals[s] / sizes[s]) < mixing.RESERVE
    return taken


@pytest.mark.parametrize(("block", "slack"), [(10_000, 3), (20, 20)])
def test_targets_and_balance(spark, block, slack):
    rows = corpus(block)
    docs = spark.createDataFrame(rows, ROWS).repartition(5)
    got = mixing.mix(docs, block=block).collect()
    checked(got, rows, slack)
    again = mixing.mix(docs.repartition(3), block=block).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_many_sources_and_limits(spark):
    rng = random.Random(3)
    rows = [(k, "w " * (300 if k < 2 else rng.randint(0, 30)), f"s{k % 40:02d}") for k in range(2000)]
    checked(mixing.mix(spark.createDataFrame(rows, ROWS)).collect(), rows, slack=5)


def test_move_keeps_totals():
    rng = random.Random(4)
    for _ in range(2000):
        sizes = [rng.choice([0, 1, 7, rng.randint(0, 10**6)]) for _ in range(3)]
        chances = [rng.uniform(0.01, 0.99) for _ in range(3)]
        moved = mixing.move(sizes, chances, rng.random())
        assert any(p in (0.0, 1.0) for p in moved) and all(0 <= p <= 1 for p in moved)
        assert sum(moved) == pytest.approx(sum(chances), abs=1e-6)
        assert sum(p * s for p, s in zip(moved, sizes)) == pytest.approx(sum(p * s for p, s in zip(chances, sizes)), abs=1e-6 * (1 + max(sizes)))


def test_chances_are_kept():
    """Over many documents the share chosen is the chance, for small and for large documents."""
    rng = random.Random(5)
    units = sorted(((rng.getrandbits(60), rng.randint(1, 100), 0.3) for _ in range(20_000)), key=lambda u: -u[1])
    chosen = [(s, p) for _, s, p in mixing.flown(iter(units), True)]
    for part in (chosen[:5_000], chosen[-5_000:]):
        assert abs(sum(p for _, p in part) / len(part) - 0.3) < 0.05


def test_repeated_rows_nulls_and_names(spark):
    rows = [(1, "same text here", "a")] * 90 + [(None, "other words", "a")] * 30 + [(2, None, "a"), (3, "", None), (4, "x y z", None), (5, "", "empty"), (6, None, "empty")]
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], ROWS + ", size long, u long")
    got = mixing.mix(docs.repartition(4), keep=["doc_id", "size", "source"])
    assert got.columns == ["doc_id", "size", "source", "size_", "source_size", "target", "copies", "taken"]
    got = got.collect()
    sizes, goals = targets(rows)
    assert len(got) == len(rows) and all(r.size == 7 for r in got)
    for s in ("a", None, "empty"):
        assert abs(sum(r.taken for r in got if r.source == s) - goals[s]) <= 3
    assert mixing.mix(spark.createDataFrame([], ROWS)).count() == 0
    assert [r.taken for r in mixing.mix(spark.createDataFrame([(1, None, "a")], ROWS)).collect()] == [0]


def test_long_text(spark):
    rows = [(1, "word " * 500_000, "a"), (2, "x" * 3_000_000, "a"), (3, "a b", "b")]
    got = {r.doc_id: r.size for r in mixing.mix(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == {1: 500_000, 2: 1, 3: 2}
