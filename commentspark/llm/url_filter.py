"""Operator 10: URL filter by rules and a character language-model ratio.  DataFrame and SQL functions only.

Rules decide first: a rule fits its host and all subdomains where the path starts with the
rule's; the longest fitting rule wins.  The URLs that rules allow and block train two
character models, which judge the others: variable-order Markov models, whose probability
of a character after its last three is smoothed by that after its last two, and so on
down to the uniform one (Witten-Bell weights).  A URL's score is the mean log ratio of the
two probabilities over its characters.  The threshold is calibrated on the rule-decided URLs
that training left out: where the scores of both classes, taken as normal, stand equally
many deviations from their means.

Models see a URL as its lower-cased text behind ``://`` with digits as 0 and other odd
characters as one symbol, so a character run has one of ``len(ALPHABET)**ORDER`` forms at
most (2.6 million): that bounds the model table, which is broadcast.  Training and scoring
run over the distinct such views with counts.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and is
judged like any other; where rules decide no URL of one class, the models are
silent: score 0, allow.  Every input row gives one output row, an empty table none; other columns, whatever their names, stay out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

ORDER = 4
KEPT = "abcdefghijklmnopqrstuvwxyz0-./_?=&%#:"
START, END, OTHER = "^", "$", "~"
ALPHABET = KEPT + START + END + OTHER
#: Rule-decided URLs whose MD5 begins with one of these are kept for calibration.
CALIBRATION = ("0", "1", "2")

Rule = tuple[str, str, str]  # verdict, host, path


def host_and_path(url: Column) -> tuple[Column, Column]:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, "://([^/?#]*)", 1), upper, upper.lower()), F.regexp_extract(text, "://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Longest fitting rule as text, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, begins in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(begins)
        rule, verdict = F.when(fits, of + begins).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def viewed(url: Column) -> Column:
    """What the models see, with its ends marked."""
    text = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)://(.*)", 1))
    plain = F.regexp_replace(F.regexp_replace(text, "[0-9]", "0"), r"[^a-z0\-./_?=&%#:]", OTHER)
    return F.concat(F.lit(START * (ORDER - 1)), plain, F.lit(END))


def judged(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict, score), one row per input row; the score is the models'."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rule, says = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "says": says, "view": viewed(F.col("url"))})
    views = common.stored(_views(rows), "url-views")
    scores = common.stored(_scores(views, _model(views)), "url-scores")
    threshold = _threshold(views.join(scores, "view"))
    score = F.lit(0.0) if threshold is None else F.col("score")
    by_model = F.when(score >= (threshold or 0.0), "allow").otherwise("block")
    out = rows.join(scores, "view", "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("says", by_model).alias("verdict"), score.alias("score"))


def _views(rows: DataFrame) -> DataFrame:
    """(view, a, r, held_a, held_r): rows that rules allow and block, for training and for calibration."""
    held = F.substring(F.md5("url"), 1, 1).isin(*CALIBRATION)
    number = lambda c: F.sum(F.when(c, 1).otherwise(0)).alias
    return rows.groupBy("view").agg(
        number((F.col("says") == "allow") & ~held)("a"), number((F.col("says") == "block") & ~held)("r"),
        number((F.col("says") == "allow") & held)("held_a"), number((F.col("says") == "block") & held)("held_r"))


def _grams(views: DataFrame) -> DataFrame:
    places = F.sequence(F.lit(1), F.length("view") - (ORDER - 1))
    return views.withColumn("gram", F.explode(F.transform(places, lambda i: F.col("view").substr(i, F.lit(ORDER)))))


def _model(views: DataFrame) -> DataFrame:
    """(gram, ratio): log ratio of the two models' probabilities of the last character after the others."""
    table = _grams(views).groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    table = common.stored(table, "url-grams").withColumn("c", F.col("gram").substr(ORDER, 1))
    out, p = table, {"a": F.lit(1.0 / len(ALPHABET)), "r": F.lit(1.0 / len(ALPHABET))}
    for k in range(ORDER):
        ctx = F.col("gram").substr(ORDER - k, k) if k else F.lit("")
        after = table.withColumn(f"h{k}", ctx).groupBy(f"h{k}", "c").agg(F.sum("a").alias(f"a{k}"), F.sum("r").alias(f"r{k}"))
        context = after.groupBy(f"h{k}").agg(*(f(F.col(f"{y}{k}")).alias(f"{y}{name}{k}") for y in "ar" for name, f in (
            ("n", F.sum), ("t", lambda c: F.sum(F.when(c > 0, 1).otherwise(0))))))
        out = out.withColumn(f"h{k}", ctx).join(after, [f"h{k}", "c"]).join(context, f"h{k}")
        for y in "ar":
            n, seen, kinds = F.col(f"{y}{k}"), F.col(f"{y}n{k}"), F.col(f"{y}t{k}")
            p[y] = F.when(seen > 0, (n + kinds * p[y]) / (seen + kinds)).otherwise(p[y])
    return common.stored(out.select("gram", F.log(p["a"] / p["r"]).alias("ratio")), "url-model")


def _scores(views: DataFrame, model: DataFrame) -> DataFrame:
    """(view, score).  The model has a row for every run that occurs, at most len(ALPHABET)**ORDER."""
    return _grams(views.select("view")).join(F.broadcast(model), "gram").groupBy("view").agg(F.avg("ratio").alias("score"))


def _threshold(scored: DataFrame) -> float | None:
    """None where a class has no URL to train or to calibrate on."""
    sums = [F.sum(F.col(f"held_{y}") * F.pow("score", F.lit(k))).alias(f"{y}{k}") for y in "ar" for k in range(3)]
    row = scored.agg(*sums, F.sum("a").alias("a"), F.sum("r").alias("r")).first()
    if not all((row["a"], row["r"], row["a0"], row["r0"])):
        return None
    mean = {y: row[f"{y}1"] / row[f"{y}0"] for y in "ar"}
    spread = {y: max(1e-12, row[f"{y}2"] / row[f"{y}0"] - mean[y] ** 2) ** 0.5 for y in "ar"}
    return (mean["a"] * spread["r"] + mean["r"] * spread["a"]) / (spread["a"] + spread["r"])


def judged_sql(rules: list[Rule], table: str = "pages") -> str:
    """The same in DuckDB, without the score."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ordered]
    pick = lambda values: "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, v in zip(fits, values, strict=True)) + " END"
    held = "substr(md5(url), 1, 1) IN (" + ", ".join(f"'{c}'" for c in CALIBRATION) + ")"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    levels, p = [], {y: f"(1.0::DOUBLE / {len(ALPHABET)})" for y in "ar"}
    joins = "grams g"
    for k in range(ORDER):
        h = f"substr(gram, {ORDER - k}, {k})" if k else "''"
        levels.append(f"after{k} AS (SELECT {h} AS h, substr(gram, {ORDER}, 1) AS c, sum(a) AS a, sum(r) AS r FROM grams GROUP BY ALL)")
        levels.append(f"context{k} AS (SELECT h, sum(a) AS an, sum(r) AS rn, sum((a > 0)::INT) AS at_, sum((r > 0)::INT) AS rt_ FROM after{k} GROUP BY h)")
        joins += (f" JOIN after{k} ON after{k}.h = {h.replace('gram', 'g.gram')} AND after{k}.c = substr(g.gram, {ORDER}, 1)"
                  f" JOIN context{k} ON context{k}.h = after{k}.h")
        for y in "ar":
            p[y] = f"(CASE WHEN context{k}.{y}n > 0 THEN (after{k}.{y} + context{k}.{y}t_ * {p[y]}) / (context{k}.{y}n + context{k}.{y}t_)::DOUBLE ELSE {p[y]} END)"
    dev = lambda y: f"sqrt(greatest(1e-12, {y}2 / {y}0 - ({y}1 / {y}0) * ({y}1 / {y}0)))"
    return f"""
WITH parsed AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
    '{START * (ORDER - 1)}' || regexp_replace(regexp_replace(lower(regexp_extract(coalesce(url, ''), '(?s)://(.*)', 1)), '[0-9]', '0', 'g'),
      '[^a-z0\\-./_?=&%#:]', '{OTHER}', 'g') || '{END}' AS view FROM {table}),
rows_ AS (SELECT *, {pick([h + p for _, h, p in ordered])} AS rule, {pick([v for v, _, _ in ordered])} AS says FROM parsed),
views AS (
  SELECT view, count(*) FILTER (says = 'allow' AND NOT {held}) AS a, count(*) FILTER (says = 'block' AND NOT {held}) AS r,
    count(*) FILTER (says = 'allow' AND {held}) AS held_a, count(*) FILTER (says = 'block' AND {held}) AS held_r FROM rows_ GROUP BY view),
places AS (SELECT view, a, r, substr(view, i, {ORDER}) AS gram FROM views, unnest(range(1, length(view) - {ORDER - 2})) AS t(i)),
grams AS (SELECT gram, sum(a) AS a, sum(r) AS r FROM places GROUP BY gram),
{", ".join(levels)},
model AS (SELECT g.gram, ln({p['a']} / {p['r']}) AS ratio FROM {joins}),
scores AS (SELECT view, avg(ratio) AS score FROM places JOIN model USING (gram) GROUP BY view),
sums AS (
  SELECT sum(a) AS a, sum(r) AS r, {", ".join(f"sum(held_{y} * score ** {k}) AS {y}{k}" for y in "ar" for k in range(3))} FROM views JOIN scores USING (view)),
bound AS (
  SELECT CASE WHEN a > 0 AND r > 0 AND a0 > 0 AND r0 > 0 THEN
    ((a1 / a0) * {dev("r")} + (r1 / r0) * {dev("a")}) / ({dev("a")} + {dev("r")}) END AS threshold FROM sums)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN (SELECT threshold FROM bound) IS NULL OR score >= (SELECT threshold FROM bound) THEN 'allow' ELSE 'block' END) AS verdict
FROM rows_ JOIN scores USING (view)"""
