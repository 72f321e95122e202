"""Operator 4: document fingerprints (SimHash).  DataFrame and SQL functions only.

A text's terms are its runs of ``WORDS`` words (lower-cased runs of letters and digits;
a shorter text is one term, one without words is its own only term).  Every occurrence
of a term votes, so its weight is its frequency: for each of 64 bits the term's hash
votes +1 or -1, and the sign of the sum is the fingerprint's bit (a tie is 0).  The votes
of bits j and j + 32 are counted in one long, so a text is 32 sums over its terms, taken
where the terms are made.

``near`` finds all pairs of fingerprints within a Hamming radius between a set of queries
and all fingerprints, by block tables: the 64 bits are cut into ``blocks`` blocks and there
is a table for each choice of blocks - radius of them, keyed by the bits of those blocks
(the permuted prefix).  Two fingerprints within the radius differ in at most ``radius``
blocks, so they meet in some table; every candidate is checked on the whole
fingerprint.

Defined cases: a null text is empty; equal texts have equal fingerprints; every input row
gives one output row.  Rows of one id come in the order of their texts where the next
document is asked for, and null ids come first.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WORDS = 5
BITS = 64
RADIUS, BLOCKS = 3, 5
#: Documents of a range in which neighbours are looked up, about.
RANGE_ROWS = 2_000
MAX_RANGES = 65_536

_PAIR = 0x100000001  # bits j and j + 32


def terms(text: Column, words: int = WORDS) -> Column:
    """Hashes of the text's terms, one for each occurrence."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]++"), F.lit(0))

    def hashed(t: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(t) - (words - 1)), lambda i: F.xxhash64(F.slice(t, i, words)))
        return F.when(F.size(t) >= words, runs).otherwise(F.array(F.xxhash64(t)))

    # As the one element of an array, the tokens are a variable of the lambda: made once, not once for each term.
    return F.transform(F.array(tokens), hashed)[0]


def votes(hashed: str) -> list[Column]:
    """Aggregates over a column of term hashes, from which ``signed`` makes the fingerprint."""
    return [F.sum(F.shiftrightunsigned(hashed, j).bitwiseAND(F.lit(_PAIR))).alias(f"b{j}") for j in range(32)] + [F.count("*").alias("n")]


def signed() -> Column:
    """The fingerprint, as a long, of the sums that ``votes`` made."""
    out = F.lit(0).cast("long")
    for j in range(32):
        low, high = F.col(f"b{j}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"b{j}", 32)
        for bit, ones in ((j, low), (j + 32, high)):
            out = out.bitwiseOR(F.when(2 * ones > F.col("n"), F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return out


def hexed(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _starts(keys: DataFrame) -> list[int]:
    """First keys of ranges of about RANGE_ROWS rows, ascending; the lowest key begins the first range."""
    n = keys.count()
    ranges = max(1, min(MAX_RANGES, -(-n // RANGE_ROWS)))
    points = keys.agg(F.min("k").alias("low"), F.percentile_approx("k", [(i + 1) / ranges for i in range(ranges)], 10 * ranges).alias("p")).first()
    return sorted({points["low"], *(points["p"] or [])}) if n else []


def _range_of(key: Column, starts: list[int]) -> Column:
    """Index of the last start <= key, by binary search in a constant array."""
    table = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    begin = F.struct(F.lit(0).alias("low"), F.lit(len(starts) - 1).alias("high"))

    def halve(a: Column, _: Column) -> Column:
        middle = ((a["low"] + a["high"] + 1) / 2).cast("int")
        right = F.get(table, middle) <= key
        return F.struct(F.when(right, middle).otherwise(a["low"]).alias("low"),
                        F.when(right, a["high"]).otherwise(F.greatest(middle - 1, a["low"])).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, len(starts).bit_length()))), begin, halve, lambda a: a["low"])


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, next, range, place): each document's text and the next one's in ascending id; after the last comes the first.

    Documents are dealt out by ranges of ids, and the first of a range stands at the end of the
    range before as well, so no window is wider than a range; ``place`` numbers a range's
    documents from 1.
    """
    k = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"), k.alias("k"))
    starts = _starts(docs.select(k.alias("k")))
    if not starts:
        return rows.select("id", "text", F.col("text").alias("next"), F.lit(0).alias("range"), F.lit(1).alias("place"))
    rows = rows.withColumn("range", _range_of(F.col("k"), starts))
    here = F.struct("range", F.lit(False).alias("halo"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(starts))).alias("range"), F.lit(True).alias("halo"))
    first = F.array_contains(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), F.col("k"))
    both = rows.select("id", "text", "k", F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here))).alias("r"))
    both = both.select("id", "text", "k", "r.range", "r.halo")
    window = Window.partitionBy("range").orderBy("halo", "k", "text")
    both = both.withColumns({"next": F.lead("text").over(window), "place": F.row_number().over(window)})
    return both.filter(~F.col("halo")).select("id", "text", "next", "range", "place")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id_col, n_chars, fingerprint) of every document; the fingerprint is a long."""
    rows = docs.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "id", F.length("text").cast("long").alias("n_chars"), F.explode(terms(F.col("text"), words)).alias("h"))
    return rows.groupBy("row", "id", "n_chars").agg(*votes("h")).select(F.col("id").alias(id_col), "n_chars", signed().alias("fingerprint"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited, next, range, place): fingerprints of every document, of its
    edit (its last quarter replaced by the beginning of the next document) and of the next document."""
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    rows = with_next(docs, id_col, text_col).withColumn("edit", F.concat(
        F.col("text").substr(F.lit(1), n - quarter), F.col("next").substr(F.lit(1), quarter)))
    rows = rows.select("range", "place", "id", n.cast("long").alias("n_chars"), F.sha2("edit", 256).alias("edited_sha256"),
                       terms(F.col("text"), words).alias("own"), terms(F.col("edit"), words).alias("other"))
    rows = rows.select("range", "place", "id", "n_chars", "edited_sha256", F.size("own").alias("n_own"), F.posexplode(F.concat("own", "other")).alias("at", "h"))
    keys = ["range", "place", "id", "n_chars", "edited_sha256"]
    # All documents of a range are in one task already: no further shuffle.
    each = rows.groupBy(*keys, (F.col("at") >= F.col("n_own")).alias("is_edit")).agg(*votes("h")).select(*keys, "is_edit", signed().alias("f"))
    both = each.groupBy(*keys).agg(F.max(F.when(~F.col("is_edit"), F.col("f"))).alias("fingerprint"), F.max(F.when(F.col("is_edit"), F.col("f"))).alias("edited"))
    both = common.stored(both, "fingerprints")
    # The fingerprint of the document after the last of a range is the first one's of the following range.
    places = both.filter("place = 1").select("range", "fingerprint")
    order = Window.orderBy("range")  # one row for each range
    following = places.select("range", F.coalesce(F.lead("fingerprint").over(order), F.first("fingerprint").over(order)).alias("after"))
    own = Window.partitionBy("range").orderBy("place")
    return both.join(following, "range").withColumn("next", F.coalesce(F.lead("fingerprint").over(own), F.col("after"))).drop("after")


def near(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fingerprint, distance) of all distinct fingerprints within the radius of distinct queries.

    Both frames have a long column ``fingerprint``.
    """
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in range(blocks)]
    tables = [sum(masks[k] for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    as_long = [m - (1 << 64) if m >= 1 << 63 else m for m in tables]

    def keyed(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col(name).bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(as_long)))
        return df.select(F.col("fingerprint").alias(name)).distinct().select(name, F.explode(keys).alias("k")).select(name, "k.t", "k.key")

    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint")))
    met = keyed(queries, "query").join(keyed(fingerprints, "fingerprint"), ["t", "key"]).withColumn("distance", distance).filter(F.col("distance") <= radius)
    # A pair counts in the first of the tables in which it meets.
    other = F.col("query").bitwiseXOR(F.col("fingerprint"))
    first = F.coalesce(*(F.when(other.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(as_long)))
    return met.filter(F.col("t") == first).select("query", "fingerprint", "distance")
