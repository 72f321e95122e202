"""The arrays of the block searches against plain sums: what is held, and what is found."""
import numpy as np
import pyarrow as pa

from commentspark.operators import batch as B


def block(docs, words, keys=None):
    out = B._Block(1.5, 0.75)
    out.words.append(pa.array(words, pa.string()))
    rows = pa.RecordBatch.from_pydict({"o": [f"d{i}" for i in range(len(docs))], "keys": pa.array(keys or [["all"]] * len(docs)), "terms": pa.array(docs, pa.list_(pa.string()))})
    for low in range(0, len(docs), 7):
        out.add(rows.slice(low, 7))
    out.close()
    out.weigh(float(np.mean([len(d) for d in docs])))
    return out


def test_a_block_holds_asked_words_only():
    docs = [["same", f"own{i}", f"other{i}", "same"] for i in range(50)]
    held = block(docs, ["same", "own3", "nowhere"])
    assert len(held.words) == 3 and len(held.doc) == len(held.tf) == 51 and held.tf.tolist() == [2] * 50 + [1]
    assert held.length.tolist() == [4.0] * 50


def test_chunks_of_queries_find_what_plain_sums_do():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(80)]
    share = 1 / np.arange(1, 81)
    docs = [rng.choice(words, rng.integers(1, 40), p=share / share.sum()).tolist() for _ in range(600)]
    keys = [["all", "neg"] if i % 3 else ["all"] for i in range(600)]
    held = block(docs, words, keys)
    asked = [rng.choice(80, rng.integers(1, 9), replace=False) for _ in range(40)]
    weights = [rng.random(len(a)) * 6 - (0.5 if i % 10 == 0 else 0) for i, a in enumerate(asked)]
    avgdl = np.mean([len(d) for d in docs])
    for key in ("all", "neg"):
        mask = held.keys.of(key)
        got = {i: [] for i in range(40)}
        for query, doc, s, hits, *_ in held.best(np.repeat(np.arange(40), [len(a) for a in asked]), np.concatenate(asked), np.concatenate(weights), 40, mask, 5):
            for q, d, x, h in zip(query.tolist(), doc.tolist(), s.tolist(), hits.tolist(), strict=True):
                got[q].append((d, x, h))
        for q, (terms, ws) in enumerate(zip(asked, weights, strict=True)):
            plain = {}
            for d, text in enumerate(docs):
                tfs = [text.count(words[t]) for t in terms]
                if mask[d] and any(tfs):
                    plain[d] = sum(w * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(text) / avgdl)) for w, tf in zip(ws, tfs, strict=True) if tf)
            best = sorted(plain.items(), key=lambda x: (-round(x[1], 6), x[0]))[:5]
            found = sorted(((d, x) for d, x, _ in got[q]), key=lambda x: (-round(x[1], 6), x[0]))[:5]
            assert [d for d, _ in found] == [d for d, _ in best] and np.allclose([x for _, x in found], [x for _, x in best], atol=1e-9, rtol=0)
            assert {h for *_, h in got[q]} <= {len(plain)}


def test_vectors_near_in_single_precision():
    """Distances that single precision can't tell apart are told apart all the same."""
    rng = np.random.default_rng(4)
    x = 1000.0 + rng.random((8, 500)) * 1e-3
    qs = 1000.0 + rng.random((20, 8)) * 1e-3
    a, b = B._square_distances(x, qs, 5)
    for q in range(20):
        d = np.sqrt(((x - qs[q][:, None]) ** 2).sum(axis=0))
        assert set(np.flatnonzero(d <= np.partition(d, 4)[4] + 1e-6).tolist()) <= set(b[a == q].tolist())
