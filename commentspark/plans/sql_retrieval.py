"""DuckDB twins of the retrieval operators.

They are written as the plain definition -- every query paired with every
document of its (filtered) corpus -- so they also check the Spark plans,
which never build those pairs for BM25.
"""

from __future__ import annotations

from ..functions.ranking import sql_distance
from ..functions.text import sql_ws_tokens
from ..operators.postings import BM25_B, BM25_EPSILON, BM25_K1, SCORE_DIGITS
from ..operators.retrieval import RRF_DIGITS, RRF_K


def bm25_ctes(tag: str, corpus: str, queries: str, n: int, keyed: bool = False) -> list[str]:
    """CTEs ending in ``{tag}_top(query_id, rank, id, score, distance)``.

    ``corpus`` has ``id, document`` (+ ``pred_keys`` when ``keyed``);
    ``queries`` has ``query_id, query`` (+ ``pred_key`` when ``keyed``).
    """
    k1, b, eps = BM25_K1, BM25_B, BM25_EPSILON
    if keyed:
        docs = (f"{tag}_docs AS (SELECT k.pred_key, c.id, {sql_ws_tokens('c.document')} AS toks FROM {corpus} c, "
                f"(SELECT unnest(pred_keys) AS pred_key, id FROM {corpus}) k WHERE k.id = c.id "
                f"AND k.pred_key IN (SELECT pred_key FROM {queries}))")
        qsel = f"SELECT query_id, query, pred_key FROM {queries}"
    else:
        docs = f"{tag}_docs AS (SELECT 'all' AS pred_key, id, {sql_ws_tokens('document')} AS toks FROM {corpus})"
        qsel = f"SELECT query_id, query, 'all' AS pred_key FROM {queries}"
    return [
        docs,
        f"{tag}_q AS ({qsel})",
        f"{tag}_dl AS (SELECT pred_key, id, len(toks) AS dl FROM {tag}_docs)",
        f"{tag}_st AS (SELECT pred_key, count(*) AS N, avg(dl) AS avgdl FROM {tag}_dl GROUP BY pred_key)",
        f"{tag}_post AS (SELECT pred_key, id, term, count(*) AS tf FROM "
        f"(SELECT pred_key, id, unnest(toks) AS term FROM {tag}_docs) GROUP BY pred_key, id, term)",
        f"{tag}_voc AS (SELECT p.pred_key, p.term, ln(s.N - count(*) + 0.5) - ln(count(*) + 0.5) AS idf0 "
        f"FROM {tag}_post p JOIN {tag}_st s USING (pred_key) GROUP BY p.pred_key, p.term, s.N)",
        f"{tag}_avg AS (SELECT pred_key, avg(idf0) AS a FROM {tag}_voc GROUP BY pred_key)",
        f"{tag}_idf AS (SELECT v.pred_key, v.term, CASE WHEN v.idf0 < 0 THEN CAST({eps} AS DOUBLE) * a.a ELSE v.idf0 END AS idf "
        f"FROM {tag}_voc v JOIN {tag}_avg a USING (pred_key))",
        f"{tag}_qt AS (SELECT query_id, pred_key, unnest({sql_ws_tokens('query')}) AS term FROM {tag}_q)",
        f"{tag}_hit AS (SELECT qt.query_id, p.id, sum(i.idf * p.tf * CAST({k1 + 1} AS DOUBLE) / "
        f"(p.tf + CAST({k1} AS DOUBLE) * (CAST({1 - b} AS DOUBLE) + CAST({b} AS DOUBLE) * d.dl / s.avgdl))) AS raw "
        f"FROM {tag}_qt qt JOIN {tag}_idf i ON i.pred_key = qt.pred_key AND i.term = qt.term "
        f"JOIN {tag}_post p ON p.pred_key = qt.pred_key AND p.term = qt.term "
        f"JOIN {tag}_dl d ON d.pred_key = p.pred_key AND d.id = p.id "
        f"JOIN {tag}_st s ON s.pred_key = p.pred_key GROUP BY qt.query_id, p.id)",
        f"{tag}_all AS (SELECT q.query_id, d.id, round(coalesce(h.raw, 0), {SCORE_DIGITS}) AS s "
        f"FROM {tag}_q q JOIN {tag}_dl d ON d.pred_key = q.pred_key "
        f"LEFT JOIN {tag}_hit h ON h.query_id = q.query_id AND h.id = d.id)",
        f"{tag}_mm AS (SELECT query_id, min(s) AS smin, max(s) AS smax FROM {tag}_all GROUP BY query_id)",
        f"{tag}_norm AS (SELECT a.query_id, a.id, a.s, CASE WHEN m.smax > m.smin THEN (a.s - m.smin) / (m.smax - m.smin) "
        f"ELSE CAST(0 AS DOUBLE) END AS norm FROM {tag}_all a JOIN {tag}_mm m USING (query_id))",
        f"{tag}_top AS (SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY norm DESC, id ASC) AS BIGINT) AS rank, "
        f"id, s AS score, 1.0 - norm AS distance FROM {tag}_norm) WHERE rank <= {n})",
    ]


def dense_ctes(tag: str, corpus: str, queries: str, n: int, metric: str = "l2", keyed: bool = False) -> list[str]:
    """CTEs ending in ``{tag}_top(query_id, rank, id, score, distance)``."""
    cond = "list_contains(c.pred_keys, q.pred_key)" if keyed else "true"
    return [
        f"{tag}_d AS (SELECT q.query_id, c.id, round({sql_distance('c.embedding', 'q.qvec', metric)}, {SCORE_DIGITS}) AS distance "
        f"FROM {queries} q JOIN {corpus} c ON {cond})",
        f"{tag}_top AS (SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance ASC, id ASC) AS BIGINT) AS rank, "
        f"id, 1.0 - distance AS score, distance FROM {tag}_d) WHERE rank <= {n})",
    ]


def rrf_ctes(tag: str, lists: list[str], n: int | None, k: int = RRF_K) -> list[str]:
    """CTEs ending in ``{tag}_top(query_id, rank, id, score, distance)``."""
    u = " UNION ALL ".join(f"SELECT query_id, id, rank, {i} AS list_no FROM {l}" for i, l in enumerate(lists))
    lim = f"WHERE rank <= {n}" if n is not None else ""
    return [
        f"{tag}_u AS ({u})",
        f"{tag}_f AS (SELECT query_id, id, round(sum(1.0 / ({k} + rank)), {RRF_DIGITS}) AS score, "
        f"min(list_no * 1000000 + rank) AS first FROM {tag}_u GROUP BY query_id, id)",
        f"{tag}_mm AS (SELECT query_id, min(score) AS smin, max(score) AS smax FROM {tag}_f GROUP BY query_id)",
        f"{tag}_top AS (SELECT * FROM (SELECT f.query_id, CAST(row_number() OVER (PARTITION BY f.query_id ORDER BY f.score DESC, f.first ASC) AS BIGINT) AS rank, "
        f"f.id, f.score, 1.0 - (f.score - m.smin) / (CASE WHEN m.smax <> m.smin THEN m.smax - m.smin ELSE 1.0 END) AS distance "
        f"FROM {tag}_f f JOIN {tag}_mm m USING (query_id)) {lim})",
    ]
