"""Lexicon sentiment scoring (X5, X6) and labels (F6).

The reference calls per-row sentiment packages; here scoring is a lexicon
job over vectorizer tokens.  A lexicon given as a Python dict is applied
row-locally through a literal map (no shuffle at all); a lexicon given as a
DataFrame -- for lexicons too large to inline -- is joined to the exploded
tokens (AQE broadcasts it where its bytes allow) and aggregated back per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ml_tokens

# --- fixed values: thresholds and normalisation ------------------------------------
POS_THRESHOLD = 0.1
NEG_THRESHOLD = -0.1
COMPOUND_ALPHA = 15.0
DIGITS = 9


def _lit_map(d: dict[str, float]) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(float(v))]
    return F.create_map(*items)


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(F.lit(0.0))


def polarity_subjectivity(text: Column, lexicon: dict[str, tuple[float, float]]) -> tuple[Column, Column]:
    """(polarity, subjectivity) = mean lexicon value over token hits, 0.0
    without hits; clamped to [-1, 1] / [0, 1], rounded to 9 digits."""
    both = _scores(text, lexicon)
    return both[0]["sentiment_polarity"], both[0]["sentiment_subjectivity"]


def _scores(text: Column, lexicon: dict[str, tuple[float, float]]) -> Column:
    """Both as the one struct of an array."""
    pmap = _lit_map({k: v[0] for k, v in lexicon.items()})
    smap = _lit_map({k: v[1] for k, v in lexicon.items()})
    # One token pass keeps the hits (a hash-set probe each); the maps see hits only.
    hits = F.filter(ml_tokens(text), lambda t: t.isin(list(lexicon)))

    def scored(h: Column) -> Column:
        pol = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _mean(F.transform(h, lambda t: F.element_at(pmap, t))))), DIGITS)
        subj = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), _mean(F.transform(h, lambda t: F.element_at(smap, t))))), DIGITS)
        return F.struct(pol.alias("sentiment_polarity"), subj.alias("sentiment_subjectivity"))

    return F.transform(F.array(hits), scored)


def compound_score(text: Column, valence: dict[str, float], alpha: float = COMPOUND_ALPHA) -> Column:
    """Second rater: ``s / sqrt(s^2 + alpha)`` with ``s`` the sum of token
    valences (the published VADER normalisation)."""
    vmap = _lit_map(valence)
    hits = F.filter(ml_tokens(text), lambda t: t.isin(list(valence)))
    s = F.aggregate(F.transform(hits, lambda t: F.element_at(vmap, t)), F.lit(0.0), lambda acc, x: acc + x)
    return F.round(s / F.sqrt(s * s + F.lit(alpha)), DIGITS)


def sentiment_label(score: Column) -> Column:
    """``> 0.1`` positive, ``< -0.1`` negative, else neutral."""
    return (F.when(score > F.lit(POS_THRESHOLD), F.lit("positive"))
            .when(score < F.lit(NEG_THRESHOLD), F.lit("negative"))
            .otherwise(F.lit("neutral")))


def score_sentiment(df: DataFrame, text_col: str, lexicon: dict[str, tuple[float, float]]) -> DataFrame:
    """X5 on a dict lexicon: adds ``sentiment_polarity``, ``sentiment_subjectivity``."""
    names = [c for c in df.columns if c not in ("sentiment_polarity", "sentiment_subjectivity")]
    # Generated, so both values come from one pass over the tokens, and no plan above works them out again.
    return df.select(*names, F.inline(_scores(F.col(text_col), lexicon)))


def score_sentiment_table(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """X5 with a lexicon *table* ``(token, polarity, subjectivity)``: tokens
    are exploded, matched to the lexicon, averaged
    per document with map-side partial aggregation, and joined back."""
    lex = lexicon.select("token", "polarity", "subjectivity")
    per_doc = (df.select(id_col, F.explode(ml_tokens(F.col(text_col))).alias("token"))
               .join(lex, "token")
               .groupBy(id_col).agg(F.sum("polarity").alias("_ps"), F.sum("subjectivity").alias("_ss"),
                                    F.count(F.lit(1)).alias("_n")))
    out = df.join(per_doc, id_col, "left")
    pol = F.coalesce(F.col("_ps") / F.col("_n"), F.lit(0.0))
    subj = F.coalesce(F.col("_ss") / F.col("_n"), F.lit(0.0))
    return (out.withColumn("sentiment_polarity", F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), pol)), DIGITS))
            .withColumn("sentiment_subjectivity", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), subj)), DIGITS))
            .drop("_ps", "_ss", "_n"))


def compound_table(df: DataFrame, id_col: str, text_col: str, valence: DataFrame, alpha: float = COMPOUND_ALPHA) -> DataFrame:
    """X6 with a valence *table* ``(token, valence)``: adds ``compound``."""
    per_doc = (df.select(id_col, F.explode(ml_tokens(F.col(text_col))).alias("token"))
               .join(valence.select("token", "valence"), "token").groupBy(id_col).agg(F.sum("valence").alias("_s")))
    s = F.coalesce(F.col("_s"), F.lit(0.0))
    return df.join(per_doc, id_col, "left").withColumn("compound", F.round(s / F.sqrt(s * s + F.lit(alpha)), DIGITS)).drop("_s")


# --- SQL twins -------------------------------------------------------------------
def _sql_case(tok: str, d: dict[str, float]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN CAST({float(v)!r} AS DOUBLE)" for k, v in d.items())
    return f"CASE {tok} {arms} ELSE NULL END"


def _sql_mean(hits: str) -> str:
    return f"(CASE WHEN len({hits}) > 0 THEN list_sum({hits}) / len({hits}) ELSE CAST(0 AS DOUBLE) END)"


def sql_polarity(tokens: str, lexicon: dict[str, tuple[float, float]]) -> str:
    hits = f"list_filter(list_transform({tokens}, lambda t: {_sql_case('t', {k: v[0] for k, v in lexicon.items()})}), lambda x: x IS NOT NULL)"
    return f"round(greatest(-1.0, least(1.0, {_sql_mean(hits)})), {DIGITS})"


def sql_subjectivity(tokens: str, lexicon: dict[str, tuple[float, float]]) -> str:
    hits = f"list_filter(list_transform({tokens}, lambda t: {_sql_case('t', {k: v[1] for k, v in lexicon.items()})}), lambda x: x IS NOT NULL)"
    return f"round(greatest(0.0, least(1.0, {_sql_mean(hits)})), {DIGITS})"


def sql_compound(tokens: str, valence: dict[str, float], alpha: float = COMPOUND_ALPHA) -> str:
    hits = f"list_filter(list_transform({tokens}, lambda t: {_sql_case('t', valence)}), lambda x: x IS NOT NULL)"
    s = f"coalesce(list_sum({hits}), CAST(0 AS DOUBLE))"
    return f"round({s} / sqrt({s} * {s} + {alpha!r}), {DIGITS})"


def sql_sentiment_label(x: str) -> str:
    return (f"CASE WHEN {x} > {POS_THRESHOLD} THEN 'positive' WHEN {x} < {NEG_THRESHOLD} "
            f"THEN 'negative' ELSE 'neutral' END")
