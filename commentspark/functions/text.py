"""Scalar text functions (Column -> Column), all JVM-side.

Python's ``\\w`` and ``\\s`` are Unicode-aware while Java's and RE2's are
ASCII, so the classes below spell the Unicode sets out.  The same pattern
strings work in Spark (Java regex) and in DuckDB (RE2); the ``sql_*``
helpers build the DuckDB twin of each function from the same constants.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: portable regex classes -------------------------------------
# Word character (Python's Unicode \w): letters, numbers, underscore.
WORD = r"\p{L}\p{N}_"
# Whitespace (Python's Unicode \s / str.isspace): separators plus the control
# characters Python treats as space.
WS = r"\p{Z}\t\n\x0B\f\r\x1c-\x1f\x{85}"

URL_RE = "http[^" + WS + "]+"
# Characters kept by cleaning: word chars, whitespace and . , ! ? ' " -
STRIP_RE = "[^" + WORD + WS + r""".,!?'"\-]"""
WS_RUN_RE = "[" + WS + "]+"
# Token pattern of the vectorizers: two or more word characters.
ML_TOKEN_RE = "[" + WORD + "]{2,}"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sq(s: str) -> str:
    """Quote a Python string as a SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# F1 ---------------------------------------------------------------------------
def clean_text(c: Column | str) -> Column:
    """Remove ``http\\S+``, drop characters outside ``\\w \\s . , ! ? ' " -``,
    collapse whitespace, strip -- in that order."""
    x = F.regexp_replace(_c(c).cast("string"), URL_RE, "")
    x = F.regexp_replace(x, STRIP_RE, "")
    x = F.regexp_replace(x, WS_RUN_RE, " ")
    return F.trim(x)


def sql_clean_text(x: str) -> str:
    y = f"regexp_replace(CAST({x} AS VARCHAR), {_sq(URL_RE)}, '', 'g')"
    y = f"regexp_replace({y}, {_sq(STRIP_RE)}, '', 'g')"
    y = f"regexp_replace({y}, {_sq(WS_RUN_RE)}, ' ', 'g')"
    return f"trim({y})"


# P1 / P3 / P4 -----------------------------------------------------------------
def strip_ws(c: Column | str) -> Column:
    """Unicode strip (Python ``str.strip()``)."""
    return F.regexp_replace(_c(c), "^[" + WS + "]+|[" + WS + "]+$", "")


def sql_strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {_sq('^[' + WS + ']+|[' + WS + ']+$')}, '', 'g')"


def is_nonblank(c: Column | str) -> Column:
    """True when the Unicode-stripped text is not empty (NULL counts as blank)."""
    return F.coalesce(_c(c).cast("string").rlike("[^" + WS + "]"), F.lit(False))  # ends at the first such character


def sql_is_nonblank(x: str) -> str:
    return f"coalesce({sql_strip_ws(f'CAST({x} AS VARCHAR)')} <> '', false)"


def fill_text(c: Column | str) -> Column:
    """``fillna('').astype(str)``."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def sql_fill_text(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '')"


# F2 ---------------------------------------------------------------------------
def ws_tokens(c: Column | str) -> Column:
    """``text.lower().split()``: whitespace split, punctuation stays on tokens."""
    parts = F.split(F.lower(_c(c)), WS_RUN_RE)
    return F.filter(parts, lambda t: t != F.lit(""))


def sql_ws_tokens(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower({x}), {_sq(WS_RUN_RE)}), "
            "lambda t: t <> '')")


# F3 ---------------------------------------------------------------------------
def ml_tokens(c: Column | str) -> Column:
    """Vectorizer tokens: lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(ML_TOKEN_RE), 0)


def sql_ml_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {_sq(ML_TOKEN_RE)})"


# A14 --------------------------------------------------------------------------
def bound(value: Column, then) -> Column:
    """``then(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of a token array, terms in order, null without tokens: counted inside the row, by
    sorting it and taking the distance from each term's first place to the next one's."""
    def counts(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return bound(first, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("long").alias("tf"))))

    return bound(F.sort_array(tokens), lambda s: F.when(F.size(s) > 0, counts(s)))


def with_clean_text(df: DataFrame, text_col: str = "comment_text", into: str = "clean_text") -> DataFrame:
    """P4 -> F1 -> P1 as one step: rows with their clean text, without those where it is blank.  A filter on a projected
    column would clean every text again for itself, and so would each projection above; rows generated from it hold it as it is."""
    clean = clean_text(fill_text(text_col))
    return df.select("*", F.explode(F.filter(F.array(clean), lambda t: t != F.lit(""))).alias(into))


# F4 ---------------------------------------------------------------------------
# The English stop-word list that Spark ML's StopWordsRemover loads, in its order.
ENGLISH_STOP_WORDS = tuple("""
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
    hers herself it its itself they them their theirs themselves what which who whom this that these
    those am is are was were be been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there when where
    why how all any both each few more most other some such no nor not only own same so than too very s
    t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
    they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
    weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
    couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
    would
""".split())


def default_stop_words() -> tuple[str, ...]:
    return ENGLISH_STOP_WORDS


def remove_stop_words(tokens: Column, stop_words: tuple[str, ...] | None = None) -> Column:
    # isin over literals is a hash set probe, not a scan of the list.
    words = list(stop_words or default_stop_words())
    return F.filter(tokens, lambda t: ~t.isin(words))


def sql_stop_list(stop_words: tuple[str, ...] | None = None) -> str:
    return "[" + ", ".join(_sq(w) for w in (stop_words or default_stop_words())) + "]"


def sql_remove_stop_words(tokens: str, stop_words: tuple[str, ...] | None = None) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({sql_stop_list(stop_words)}, t))"


# F5 ---------------------------------------------------------------------------
def bigrams(tokens: Column) -> Column:
    """Adjacent pairs ``'a b'`` of a token array (order kept)."""
    following = F.slice(tokens, 2, F.size(tokens))
    pairs = F.zip_with(tokens, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda g: g.isNotNull())


def uni_and_bigrams(tokens: Column) -> Column:
    return F.concat(tokens, bigrams(tokens))


def sql_bigrams(tokens: str) -> str:
    return (f"list_transform(range(1, len({tokens})), "
            f"lambda i: {tokens}[i] || ' ' || {tokens}[i + 1])")


def sql_uni_and_bigrams(tokens: str) -> str:
    return f"list_concat({tokens}, {sql_bigrams(tokens)})"
