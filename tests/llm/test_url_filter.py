import math
import re
from collections import Counter, defaultdict
from hashlib import md5

import duckdb

from commentspark.llm import url_filter as U

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def parts(url):
    _, sep, rest = (url or "").partition("://")
    host = re.match("[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match("[^?#]*", rest[len(host):]).group()


def rule_of(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def view(url):
    text = (url or "").partition("://")[2].lower()
    return "^^^" + "".join("0" if c in "0123456789" else c if c in U.KEPT else "~" for c in text) + "$"


def brute(rows):
    """Verdicts, from models that count every order on its own."""
    counts, held = {"allow": defaultdict(Counter), "block": defaultdict(Counter)}, {"allow": [], "block": []}
    for _, url in rows:
        says = rule_of(*parts(url))[1]
        if says and md5(url.encode()).hexdigest()[0] not in U.CALIBRATION:
            v = view(url)
            for i in range(3, len(v)):
                for k in range(4):
                    counts[says][v[i - k:i]][v[i]] += 1

    def prob(y, h, c, k):
        low = 1 / len(U.ALPHABET) if k < 0 else prob(y, h[1:], c, k - 1)
        seen = counts[y].get(h if k >= 0 else None)
        return (seen[c] + len(seen) * low) / (sum(seen.values()) + len(seen)) if k >= 0 and seen else low

    def score(url):
        v = view(url)
        return sum(math.log(prob("allow", v[i - 3:i], v[i], 3) / prob("block", v[i - 3:i], v[i], 3)) for i in range(3, len(v))) / (len(v) - 3)

    for _, url in rows:
        says = rule_of(*parts(url))[1]
        if says and md5(url.encode()).hexdigest()[0] in U.CALIBRATION:
            held[says].append(score(url))
    silent = not all(held.values()) or not all(counts.values())
    stats = {}
    if not silent:
        for y, x in held.items():
            m = sum(x) / len(x)
            stats[y] = m, max(1e-12, sum(t * t for t in x) / len(x) - m * m) ** 0.5
        (a, s), (b, t) = stats["allow"], stats["block"]
        bound = (a * t + b * s) / (s + t)
    out = []
    for page, url in rows:
        host, path = parts(url)
        rule, says = rule_of(host, path)
        out.append((page, host, path, rule, says or ("allow" if silent or score(url) >= bound else "block")))
    return sorted(out, key=str)


ODD = [(900, None), (901, ""), (902, "no scheme.com/"), (903, "HTTP://WWW.Example.COM/EN/x"), (904, "http://www.example.com/en/a?b#c"), (905, "http://com/"), (906, "http://com"),
       (907, "x://a.example.com/en/"), (908, "http://badexample.com/en/"), (909, "http://a://b.net/fr/"), (910, "http://É.net/es/ü\n?"), (911, "u://" + "z" * 5_000), (912, "http://net/es/"),
       (903, "HTTP://WWW.Example.COM/EN/x"), (None, "http://q.org/"), (913, "http://q.org/en#x://y.com/")]


def run(spark, rows):
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "page_id long, url string, score double")
    return sorted((tuple(r)[:5] for r in U.judged(df, RULES).collect()), key=str)


def test_against_brute_force(spark):
    rows = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()] + ODD
    assert run(spark, rows) == brute(rows)


def test_without_labels(spark):
    rows = [(1, "http://a.org/x"), (2, "http://b.org/y")]
    assert [r[4] for r in run(spark, rows)] == ["allow", "allow"] == [r[4] for r in brute(rows)]
    df = spark.createDataFrame([], "page_id long, url string")
    assert U.judged(df, RULES).count() == 0


def test_query_against_sql(spark):
    from commentspark.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    out = QUERIES["op10_url_filter"](spark, sf)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
    got = sorted(map(tuple, out.collect()))
    assert got == sorted(con.execute(ORACLE["op10_url_filter"]).fetchall())
    assert {"allow", "block"} == {r[4] for r in got if r[3] is None}
