"""Operator 8: line dedup by a log-template tree.

Lines are parsed as log messages.  A path of the tree is a line's tokens: their count, the ``DEPTH`` leading ones, the others.  At
every level a token that looks variable (it has a digit, a slash, a backslash or an at sign, or is a
word of ``HEX`` hexadecimal digits or more) generalises to the wildcard; no other token does.  So the masked line is the
whole path, and is grouped by as it is: its count and leading tokens, which it holds, are no keys beside it.  The path is a
line's template, if at least ``CONSTANT`` of its tokens, and of those behind the leading ones, are no wildcards; otherwise its
own text is.

``by_support`` generalises by the data too, as the query does: lines of one count and equal (masked) leading tokens are a leaf, and
there a token is constant at its position only if lines of at least ``MIN_DOCS`` documents have it there (a document counts once
for each of its different lines); all others are wildcards, however they look.  What is left of the line is its
template, by the same shares of constants, so prose that shares an opening and no more is none.

A template that lines of ``MIN_DOCS`` documents have is dropped from all but the first of them, that with the
smallest id, so a passage that documents share survives once.  A long line (``LONG_TOKENS`` tokens or ``LONG_CHARS`` characters)
of equal text is, from two documents on.

Lines recur by chance, and stay, if they have fewer than ``MIN_TOKENS`` tokens and fewer than ``MIN_CHARS`` characters, blanks not counted;
those of enough characters only (scripts without spaces) have no template but their text.

A template is a grouping key, never a task's data: documents are counted over distinct (template, document), pre-aggregated
before each shuffle, and all lines whose template no second document has are gone after the first, which moves two numbers
per line.

Defined cases: a null text has no lines (and stays null); Unicode blanks separate tokens like spaces, and only \\n ends a line; equal rows are one document
and get equal results; rows with one id but other texts are documents of their own; a null
id comes first in order; an empty table gives an empty one; columns of any names stay, and the two that are added get an underscore where
theirs are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

DEPTH = 3
MIN_DOCS, MIN_EQUAL = 3, 2
MIN_TOKENS, MIN_CHARS = 4, 20
LONG_TOKENS, LONG_CHARS = 30, 200
CONSTANT = 0.6
HEX = 8
WILDCARD = "<*>"
#: Blanks of all kinds but the line's end.
BLANKS = r"[\p{Z}\t\x0B\f\r\x{85}]+"


def lines_of(text: Column) -> Column:
    """The lines of a text, with one space between tokens (a line may still begin or end with one)."""
    odd = text.contains("  ") | text.rlike(r"[^\x00-\x7F]|[\t\x0B\f\r]")
    return F.split(F.when(odd, F.regexp_replace(text, BLANKS, " ")).otherwise(text), "\n")


def masked(tokens: Column) -> Column:
    """Tokens that look variable become the wildcard; each token is looked at once, however long."""
    return F.regexp_replace(tokens, r"(?<![^ ])(?:[^ 0-9/\\@]*+[0-9/\\@][^ ]*+|[A-Fa-f]{%d,}+(?![^ ]))" % HEX, WILDCARD)


def _wildcards(tokens: Column) -> Column:
    return F.when(tokens.contains(WILDCARD), F.size(F.filter(F.split(tokens, " "), lambda t: t == WILDCARD))).otherwise(0)


def _taking_part(lines: DataFrame) -> DataFrame:
    """Adds to each ``line`` that takes part its ``tokens``, their number ``n`` and that of their characters ``chars``."""
    lines = lines.withColumn("tokens", F.trim("line"))
    spaces = F.length("tokens") - F.length(F.replace(F.col("tokens"), F.lit(" "), F.lit("")))
    lines = lines.withColumns({"n": F.when(F.col("tokens") == "", 0).otherwise(spaces + 1), "chars": F.length("tokens") - spaces})
    return lines.filter((F.col("n") >= MIN_TOKENS) | (F.col("chars") >= MIN_CHARS))


def _own() -> Column:
    return F.xxhash64(F.lit("own"), "tokens")


def _can_vary(depth: int, constant: float) -> Column:
    """Whether a line has tokens enough for one behind the leading ones to be generalised by support."""
    return (F.col("n") >= MIN_TOKENS) & (F.col("n") - depth - 1 >= constant * (F.col("n") - depth))


def _parsed(lines: DataFrame, depth: int, constant: float) -> DataFrame:
    """Adds to each ``line`` that takes part the hashes ``template`` and ``own`` (its text), whether it is ``long``, and its ``leaf`` (hash) where
    support can generalise it."""
    lines = _taking_part(lines).withColumn("masked", F.when(F.col("n") >= MIN_TOKENS, masked(F.col("tokens"))))
    head = F.substring_index("masked", " ", depth)
    wild, behind = _wildcards(F.col("masked")), _wildcards(F.col("masked")) - _wildcards(head)
    general = (F.col("n") - wild >= constant * F.col("n")) & (F.col("n") - depth - behind >= constant * (F.col("n") - depth))
    return lines.withColumns({"own": _own(), "template": F.when(F.col("masked").isNotNull() & general, F.xxhash64(F.lit("masked"), "masked")).otherwise(_own()),
                              "long": (F.col("n") >= LONG_TOKENS) | (F.col("chars") >= LONG_CHARS),
                              "leaf": F.when(_can_vary(depth, constant), F.xxhash64("n", head))})


def _generalised(texts: DataFrame, lines: DataFrame, depth: int, min_docs: int, constant: float) -> DataFrame:
    """(id, d, pos) of the lines that go as their template by support recurs.  Such a template holds all lines of a masked one, so what is kept
    here is kept there as well.  Only documents with lines of mixed leaves are read again for their tokens."""
    lines = lines.filter(F.col("leaf").isNotNull()).select("id", "d", "pos", "leaf", "own")
    shared = lines.select("leaf", "d").distinct().groupBy("leaf").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs).select("leaf")
    found = common.stored(lines.join(shared, "leaf"), "leaf-lines")
    each = found.select("leaf", "own", "d").distinct().groupBy("leaf", "own").agg(F.count("*").alias("docs"))
    # A leaf with one line has nothing to generalise.
    alike = Window.partitionBy("leaf")
    each = common.stored(each.withColumn("lines", F.count("*").over(alike)).filter("lines > 1").drop("lines"), "mixed-leaves")
    mixed = each.select("leaf").distinct()
    in_leaf, in_doc = common.bit_filter(mixed, "leaf"), common.bit_filter(found.join(mixed, "leaf", "left_semi"), "d")
    again = _taking_part(texts.filter(in_doc(F.col("d"))).select(F.explode(lines_of(F.col("text"))).alias("line"))).filter(_can_vary(depth, constant))
    again = again.withColumn("leaf", F.xxhash64("n", masked(F.substring_index("tokens", " ", depth)))).filter(in_leaf(F.col("leaf")))
    again = again.select("leaf", _own().alias("own"), "n", masked(F.col("tokens")).alias("masked")).distinct().join(each, ["leaf", "own"])
    parts = again.select("leaf", "own", "n", "docs", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    fixed = (parts.filter(F.col("token") != WILDCARD).groupBy("leaf", "at", "token").agg(F.sum("docs").alias("support"))
             .filter(F.col("support") >= min_docs).select("leaf", "at", "token", F.lit(True).alias("fixed")))
    token = F.when(F.col("fixed"), F.col("token")).otherwise(F.lit(WILDCARD))
    shaped = parts.drop("docs").join(fixed, ["leaf", "at", "token"], "left").groupBy("leaf", "own", "n").agg(
        F.bit_xor(F.xxhash64("at", token)).alias("shape"), F.count("fixed").alias("constants"), F.count_if(F.col("fixed") & (F.col("at") >= depth)).alias("behind"))
    general = (F.col("constants") >= constant * F.col("n")) & (F.col("behind") >= constant * (F.col("n") - depth))
    typed = common.stored(found.join(shaped.filter(general).select("leaf", "own", "shape"), ["leaf", "own"]).select("id", "d", "pos", "leaf", "shape"), "line-shapes")
    recurring = (typed.select("leaf", "shape", "id", "d").distinct().groupBy("leaf", "shape")
                 .agg(F.count_distinct("d").alias("docs"), F.min(F.struct("id", "d")).alias("first")).filter(F.col("docs") >= min_docs))
    return typed.join(recurring.select("leaf", "shape", F.col("first.d").alias("first")), ["leaf", "shape"]).filter(F.col("d") != F.col("first")).select("id", "d", "pos")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS,
                  constant: float = CONSTANT, by_support: bool = False) -> DataFrame:
    """(id, d, drops): the positions, from 0, of the lines that go, for each document that loses any; d is ``document_key``."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("d", document_key("id", "text"))
    lines = texts.select("id", "d", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    leaf = ["leaf"] if by_support else []
    lines = common.stored(_parsed(lines, depth, constant).select("id", "d", "pos", "template", "own", "long", *leaf), "lines")
    shared = lines.select("template", "d").distinct().groupBy("template").agg(F.count("*").alias("docs")).filter(F.col("docs") >= MIN_EQUAL).select("template")
    found = common.stored(lines.drop("leaf").join(shared, "template"), "shared-lines")

    def recurring(by: str, least: Column) -> DataFrame:
        docs_of = found.select(by, "long", "id", "d").distinct().groupBy(by).agg(
            F.count_distinct("d").alias("docs"), F.min(F.struct("id", "d")).alias("first"), F.max("long").alias("long"))
        return docs_of.filter(F.col("docs") >= least).select(by, F.col("first.d").alias(f"first_{by}"))

    least_equal = F.when(F.col("long"), MIN_EQUAL).otherwise(min_docs)
    first = F.coalesce("first_template", "first_own")
    going = (found.join(recurring("template", F.lit(min_docs)), "template", "left").join(recurring("own", least_equal), "own", "left")
             .filter(first.isNotNull() & (F.col("d") != first))).select("id", "d", "pos")
    if by_support:
        going = going.union(_generalised(texts, lines, depth, min_docs, constant))
    return going.groupBy("id", "d").agg(F.collect_set("pos").alias("drops"))


def document_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(id_col, text_col)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input with the text less its dropped lines, and ``n_lines`` and ``n_dropped`` beside (taken names get an underscore)."""
    n_lines, n_dropped, key, split, of, d, gone = (common.fresh(docs, c) for c in ("n_lines", "n_dropped", "key", "lines", "of", "d", "drops"))
    drops = dropped_lines(docs, id_col, text_col, **options).select(F.col("id").alias(of), F.col("d").alias(d), F.col("drops").alias(gone))
    keyed = docs.withColumn(key, document_key(id_col, text_col))
    joined = keyed.join(drops, (F.col(key) == F.col(d)) & F.col(id_col).eqNullSafe(F.col(of)), "left")
    lines = F.split(text_col, "\n")
    joined = joined.withColumn(n_lines, F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines))).withColumn(
        n_dropped, F.coalesce(F.size(gone), F.lit(0)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    joined = joined.withColumn(split, F.when(F.col(gone).isNotNull(), lines))
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n"))
    return joined.withColumn(text_col, text).select(*docs.columns, n_lines, n_dropped)


def dedup_sql(table: str = "documents") -> str:
    """The same in DuckDB, by support too, for unique ids."""
    return f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM {table} WHERE text IS NOT NULL),
tok AS (SELECT doc_id, pos, trim(regexp_replace(line, '{BLANKS}', ' ', 'g')) AS tokens FROM lines),
parsed AS (
  SELECT doc_id, pos, tokens, string_split(tokens, ' ') AS list, len(string_split(tokens, ' ')) AS n, length(replace(tokens, ' ', '')) AS chars
  FROM tok WHERE tokens <> ''),
part AS (SELECT *, n >= {LONG_TOKENS} OR chars >= {LONG_CHARS} AS long,
    list_transform(list, lambda t: CASE WHEN regexp_matches(t, '[0-9/\\@]|^[A-Fa-f]{{{HEX},}}$') THEN '{WILDCARD}' ELSE t END) AS mask
  FROM parsed WHERE n >= {MIN_TOKENS} OR chars >= {MIN_CHARS}),
shared AS (SELECT n, mask[1:{DEPTH}] AS head FROM part WHERE n >= {MIN_TOKENS} GROUP BY ALL HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
each AS (
  SELECT n, mask[1:{DEPTH}] AS head, tokens, any_value(mask) AS mask, count(DISTINCT doc_id) AS docs FROM part SEMI JOIN shared s ON s.n = part.n AND s.head = part.mask[1:{DEPTH}]
  GROUP BY ALL),
spots AS (SELECT n, head, tokens, docs, unnest(mask) AS token, unnest(range(n)) AS spot FROM each),
fixed AS (SELECT n, head, spot, token FROM spots WHERE token <> '{WILDCARD}' GROUP BY ALL HAVING sum(docs) >= {MIN_DOCS}),
shaped AS (
  SELECT p.n, p.head, p.tokens, string_agg(CASE WHEN f.token IS NULL THEN '{WILDCARD}' ELSE p.token END, ' ' ORDER BY p.spot) AS shape,
    count(f.token) AS constants, count(f.token) FILTER (p.spot >= {DEPTH}) AS behind
  FROM spots p LEFT JOIN fixed f ON f.n = p.n AND f.head = p.head AND f.spot = p.spot AND f.token = p.token GROUP BY p.n, p.head, p.tokens),
typed AS (SELECT doc_id, pos, part.tokens, long, CASE WHEN constants >= {CONSTANT} * shaped.n AND behind >= {CONSTANT} * (shaped.n - {DEPTH})
    THEN 't' || shape ELSE 'o' || part.tokens END AS template FROM part LEFT JOIN shaped USING (tokens)),
by_template AS (SELECT template, min(doc_id) AS first FROM typed GROUP BY template HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
by_text AS (SELECT tokens, min(doc_id) AS first FROM typed GROUP BY tokens HAVING count(DISTINCT doc_id) >= CASE WHEN bool_or(long) THEN {MIN_EQUAL} ELSE {MIN_DOCS} END),
going AS (SELECT doc_id, pos FROM typed LEFT JOIN by_template a USING (template) LEFT JOIN by_text b USING (tokens) WHERE doc_id <> coalesce(a.first, b.first)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text, count(*) AS n FROM lines l ANTI JOIN going g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) - coalesce(k.n, 0) END AS n_dropped
FROM {table} d LEFT JOIN kept k USING (doc_id)"""
