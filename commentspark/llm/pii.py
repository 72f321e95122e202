"""Operator 2: personal data, by weak supervision.  DataFrame and SQL functions only.

Patterns propose candidate spans.  Four base kinds (e-mail, IP address, payment card,
international phone) are kept whatever the model says; further kinds (secrets, national
phone numbers, social security numbers, account numbers, titled names) are added where the
model accepts them.

Five labelers look at every candidate and vote for, against, or not at all: the strict
shape of the kind (regex), a checksum or structure test, lists of known prefixes,
domains, calling codes and titles (gazetteers), cue words before it (context), and what
it touches (boundary).  Expectation-maximisation estimates how far each labeler can be
trusted and the probability that a candidate is personal data; those probabilities train
the span classifier, a logistic model of the span's own features (kind, length,
composition, neighbours, cue), which takes the decision.

Votes and features are a short code, so both models are fitted on the counts of the codes
that occur, at most a few thousand whatever the corpus; each step is one aggregation, of
which the driver sees a row for each vote or feature.  Texts are read once for the counts
and once for the spans, and are never shuffled.

Positions count code points, the end is exclusive.  Patterns are written without
backtracking (possessive, anchored at the start of a run or at the last match's end), so a
text that is one long run costs linear time.  So does a text of many matches: starts are
running sums taken in blocks, what surrounds a span is cut from pieces of the text, and
the base spans that an added one meets are found by bisection.

Defined cases: a null text is empty and has no span; every input row gives one output row;
matches of one kind never overlap, matches of different kinds may, but an added span never
overlaps a base one: a secret of any length that still is one up to the first base span in it
is cut into the pieces beside base spans, other added spans that meet one go; an empty table gives no
rows and accepts no added kind; other columns stay, and the added one's name is the caller's.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "national_phone", "ssn", "iban", "name")
KINDS = BASE + ADDED
LABELERS = ("shape", "structure", "gazetteer", "context", "boundary")
ROUNDS = 12
#: Characters before a candidate in which the context labeler looks for cues.
CONTEXT = 40
#: Code points of a piece of a text, and values of a block of running values.
PIECE = 256

_LOCAL = "[A-Za-z0-9._%+-]"
_RUN = r"(?:(?<!{0})|\G)"
PATTERNS = {
    "email": _RUN.format(_LOCAL) + _LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": (r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:ghp_|xox[abp]-|sk-)[A-Za-z0-9-]{16,}+|"
               r"(?i:\b(?:password|passwd|pwd|secret|token|api_?key))[\x20]?[=:][\x20]?\"?[^\s\",;]{8,}+"),
    "national_phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[\x20]?[0-9A-Z]{4}){2,7}+(?:[\x20]?[0-9A-Z]{1,3})?+(?![0-9A-Za-z])",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?[\x20]\p{Lu}\p{Ll}++(?:[\x20]\p{Lu}\p{Ll}++)?",
}
#: A text without it has no candidate of the kind.
GATES = {"email": "@", "phone": "+", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "secret": "AKIA|ASIA|ghp_|xox|sk-|(?i:pass|pwd|secret|token|key)",
         "national_phone": "[0-9]{3}[.-][0-9]{4}", "ssn": "[0-9]-[0-9]{2}-[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "name": "Mr|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor"}

# Public lists the gazetteer and context labelers look things up in.
TOP_DOMAINS = "com org net edu gov io co uk de fr es it nl eu info".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 55 61 64 81 82 86 91".split()
CUES = {
    "email": "e-?mail|contact|write|reach|correo|courriel",
    "ip": "ip|address|host|server|adresse|dirección",
    "card": "card|visa|master|credit|pay|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|anruf|teléfono",
    "secret": "password|passwd|pwd|secret|token|key|credential",
    "national_phone": "phone|tel|call|fax|mobile",
    "ssn": "ssn|social|security",
    "iban": "iban|account|konto|compte|cuenta",
    "name": "name|by|from|dear|signed|contact",
}
COUNTER_CUES = "version|release|isbn|section|figure|order|licen[cs]e|revision|build"


def octets_fit(found: Column) -> Column:
    return found.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$")


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string (of any parity) passes the Luhn test."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(kind: str, found: Column) -> Column:
    """What a match of a base kind must also meet."""
    digits = digits_of(found)
    if kind == "ip":
        return octets_fit(found)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _between(pieces: Column, low: Column, high: Column) -> Column:
    """The text from ``low`` to ``high``, of its pieces: a place far inside costs no more than one at the start."""
    place = lambda at: F.shiftright(at, PIECE.bit_length() - 1)
    joined = F.array_join(F.transform(F.sequence(place(low), place(high - 1)), lambda k: F.get(pieces, k)), "")
    return F.when(low < high, joined.substr(F.pmod(low, F.lit(PIECE)) + 1, high - low)).otherwise(F.lit(""))


def _running(values: Column, grow) -> Column:
    """For each value (int, at least one), ``grow`` over all values before it, from 0; ``grow`` is associative."""
    def grown(array: Column) -> Column:
        zero = F.array(F.lit(0))
        return F.aggregate(array, zero, lambda a, x: F.concat(a, F.array(grow(F.element_at(a, -1), x))))

    def laid(values: Column) -> Column:
        block = lambda b: F.transform(F.sequence(b * PIECE, F.least((b + 1) * PIECE, F.size(values)) - 1), lambda i: F.get(values, i))
        blocks = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(values) - 1, PIECE.bit_length() - 1)), lambda b: grown(block(b)))
        return _let(blocks, lambda parts: _let(grown(F.transform(parts, lambda p: F.element_at(p, -1))), lambda bases: F.flatten(
            F.transform(parts, lambda p, b: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: grow(F.get(bases, b), x))))))
    return _let(values, laid)


def matches(text: Column, kind: str) -> Column:
    """Array of (start, found), in order, for the kind's pattern."""
    gate = text.contains(GATES[kind]) if kind in ("email", "phone") else text.rlike(GATES[kind])
    kind_of = "array<struct<start:int,found:string>>"

    def placed(found: Column) -> Column:
        gaps = F.transform(F.split(text, PATTERNS[kind], -1), F.length)
        steps = F.filter(F.arrays_zip(found.alias("found"), gaps.alias("gap")), lambda s: s["found"].isNotNull())

        def started(steps: Column) -> Column:
            before = _running(F.transform(steps, lambda s: s["gap"] + F.length(s["found"])), lambda a, x: a + x)
            return F.zip_with(before, steps, lambda at, s: F.struct((at + s["gap"]).alias("start"), s["found"].alias("found")))
        return F.when(F.size(found) > 0, _let(steps, started)).otherwise(F.array().cast(kind_of))

    summed = _let(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), placed)
    return F.when(gate, F.filter(summed, lambda m: valid(kind, m["found"]))).otherwise(F.array().cast(kind_of))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "+").when(no, "-").otherwise("0")


def _code(kind: str, found: Column, before: Column, after: Column) -> Column:
    """kind:votes:features."""
    digits, size, never = digits_of(found), F.length(found), F.lit(False)
    shape = {
        "email": _vote(found.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"), found.rlike(r"\.[0-9]+$|^[._%+-]")),
        "ip": _vote(found.rlike(r"^(?:[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$"), found.rlike(r"(?:^|\.)0[0-9]")),
        "card": _vote(found.rlike(r"^[0-9]{16}$|^(?:[0-9]{4}[ -]){3}[0-9]{4}$"), found.rlike(r"^[0-9](?:[ -][0-9])+$")),
        "phone": _vote(found.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}$"), found.rlike(r"[(.-]{2}|[)]{2}")),
        "secret": _vote(found.rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|[=:] ?\"?[0-9a-f]{16,}$|^(?:ghp_|xox|sk-)"), found.rlike(r"[=:] ?\"?\p{L}+\.?$")),
        "national_phone": _vote(found.rlike(r"^\([0-9]{3}\) [0-9]{3}-[0-9]{4}$|^[0-9]{3}-[0-9]{3}-[0-9]{4}$"), found.rlike(r"^0|\)\.|\(.*[^)]\..*")),
        "ssn": _vote(found.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"), found.rlike("^(?:000|666|9)|-00-|-0000$")),
        "iban": _vote(found.rlike("^(?:DE|FR|ES|GB|IT|NL)[0-9]{2}"), found.rlike("^[A-Z]{2}00")),
        "name": _vote(found.rlike(r" \p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$"), never),
    }[kind]
    body = F.regexp_extract(found, r"(?<![^=:\s\"])([^=:\s\"]++)$", 1)
    structure = {
        "email": _vote(size.between(6, 64), size > 254),
        "ip": _vote(octets_fit(found), found.rlike("^0")),
        "card": _vote(luhn(digits), ~luhn(digits)),
        "phone": _vote(F.length(digits).between(10, 14), F.length(digits) < 9),
        "secret": _vote(body.rlike("[0-9]") & body.rlike("[A-Za-z]") & (F.length(body) >= 12), ~body.rlike("[0-9]")),
        "national_phone": _vote(found.rlike("^.?[2-9]"), found.rlike("^.?[01]")),
        "ssn": _vote(found.rlike("^[0-8]"), found.rlike("^9")),
        "iban": _vote(F.length(F.replace(found, F.lit(" "), F.lit(""))).between(15, 34) & found.rlike("[0-9]{6}"), ~found.rlike("[0-9]{4}$")),
        "name": _vote(size >= 8, size < 5),
    }[kind]
    gazetteer = {
        "email": _vote(F.lower(F.substring_index(found, ".", -1)).isin(TOP_DOMAINS), never),
        "ip": _vote(found.rlike(r"^(?:10|172|192)\."), found.rlike(r"^(?:0|127|255)\.")),
        "card": _vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), digits.rlike("^[01789]")),
        "phone": _vote(digits.rlike("^(?:" + "|".join(CALLING_CODES) + ")"), digits.rlike("^0")),
        "secret": _vote(found.rlike("^(?:AKIA|ASIA|ghp_|xox|sk-)|(?i:^(?:password|passwd|pwd))"), never),
        "national_phone": _vote(found.rlike("555|^.?800"), never),
        "ssn": _vote(never, found.rlike("^(?:123-45-6789|078-05-1120)")),
        "iban": _vote(found.rlike("^(?:DE|FR|ES|GB|IT|NL|CH|AT|BE)"), never),
        "name": _vote(found.rlike("^(?:Mr|Mrs|Ms|Dr|Herr|Frau)"), never),
    }[kind]
    cue = F.lower(before).rlike(r"\b(?:" + CUES[kind] + ")")
    counter = F.lower(before).rlike(r"\b(?:" + COUNTER_CUES + r")\P{L}*$")
    context = _vote((cue if kind != "secret" else cue | F.lower(found).rlike("^(?:" + CUES[kind] + ")")) & ~counter, counter)
    boundary = _vote(~before.rlike(r"[\p{L}\p{N}_/\\]$") & ~after.rlike(r"^[\p{L}\p{N}_/\\]"), before.rlike(r"[\p{L}\p{N}_]$") | after.rlike(r"^[\p{L}\p{N}_]"))
    length = F.when(size < 10, "a").when(size < 18, "b").when(size < 32, "c").otherwise("d")
    composed = F.when(found.rlike(r"^[^\p{L}]*$"), "n").when(found.rlike("[0-9]"), "m").otherwise("l")
    side = lambda c, at: F.when(c == "", "e").when(c.rlike(at(r"\s")), "s").when(c.rlike(at(r"[\p{L}\p{N}_]")), "w").otherwise("p")
    features = F.concat(length, composed, side(before, lambda p: p + "$"), side(after, lambda p: "^" + p), F.when(cue, "y").otherwise("n"))
    return F.concat(F.lit(kind + ":"), shape, structure, gazetteer, context, boundary, F.lit(":"), features)


FEATURES = ("abcd", "nml", "eswp", "eswp", "yn")


def _first(spans: Column, holds) -> Column:
    """Index of the first span for which ``holds``, or their number, by bisection: it holds for all after the first."""
    begin = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

    def step(a: Column, _: Column) -> Column:
        middle = F.shiftright(a["low"] + a["high"], 1)
        yes = holds(F.get(spans, middle))
        halved = F.struct(F.when(yes, a["low"]).otherwise(middle + 1).alias("low"), F.when(yes, middle).otherwise(a["high"]).alias("high"))
        return F.when(a["low"] < a["high"], halved).otherwise(a)

    rounds = F.sequence(F.lit(0), F.floor(F.log2(F.size(spans) + 1)).cast("int"))
    return F.aggregate(rounds, begin, step, lambda a: a["low"])


def _meets(spans: Column, c: Column) -> Column:
    """Whether a span among ``spans`` (ordered, none overlaps another) overlaps ``c``."""
    there = F.get(spans, _first(spans, lambda b: b["end"] > c["start"]))
    return (F.size(spans) > 0) & F.coalesce(there["start"] < c["end"], F.lit(False))


def _met(spans: Column, c: Column) -> Column:
    """Those spans, as (start, end)."""
    low, high = _first(spans, lambda b: b["end"] > c["start"]), _first(spans, lambda b: b["start"] >= c["end"])
    told = F.transform(F.sequence(low, high - 1), lambda i: F.struct(F.get(spans, i)["start"].alias("start"), F.get(spans, i)["end"].alias("end")))
    return F.when(_meets(spans, c), told).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def candidates(docs: DataFrame, text_col: str = "text", into: str = "candidates") -> DataFrame:
    """Adds an array of (kind, start, end, code), in the order of the kinds, then of the starts."""
    text, pieces, base = common.text_or_empty(text_col), common.fresh(docs, "pieces"), {k: common.fresh(docs, f"base_{k}") for k in BASE}

    def told(kind: str) -> Column:
        def around(m: Column) -> Column:
            start, end = m["start"], m["start"] + F.length(m["found"])
            return F.struct(start.alias("start"), end.alias("end"), m["found"].alias("found"),
                            _between(F.col(pieces), F.greatest(start - CONTEXT, F.lit(0)), start).alias("before"),
                            _between(F.col(pieces), end, end + 2).alias("after"))

        def one(m: Column) -> Column:
            return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), _code(kind, m["found"], m["before"], m["after"]).alias("code"))
        return F.transform(F.transform(matches(text, kind), around), one)

    def beside(c: Column) -> Column:
        piece = lambda low, high: F.struct(c["kind"].alias("kind"), low.alias("start"), high.alias("end"), c["code"].alias("code"))
        begin = F.struct(c["start"].alias("at"), F.filter(F.array(c), lambda _: F.lit(False)).alias("out"))
        grown = lambda a, high: F.when(a["at"] < high, F.concat(a["out"], F.array(piece(a["at"], high)))).otherwise(a["out"])

        def cut(hits: Column) -> Column:
            parts = F.aggregate(hits, begin, lambda a, b: F.struct(F.greatest(a["at"], b["end"]).alias("at"), grown(a, b["start"]).alias("out")), lambda a: grown(a, c["end"]))
            head = _between(F.col(pieces), c["start"], F.get(hits, F.lit(0))["start"])
            return F.when(head.rlike("^(?:" + PATTERNS["secret"] + ")"), parts).otherwise(F.slice(parts, 1, 0))
        return F.when(meets(c), _let(F.array_sort(F.concat(*(_met(F.col(base[k]), c) for k in BASE))), cut)).otherwise(F.array(c))

    def meets(c: Column) -> Column:
        return F.greatest(*(_meets(F.col(base[k]), c) for k in BASE))

    df = docs.withColumn(pieces, _pieces(text))
    df = df.withColumns({base[k]: told(k) for k in BASE})
    added = F.filter(F.concat(*(told(k) for k in ADDED[1:])), lambda c: ~meets(c))
    secrets = F.flatten(F.transform(told(ADDED[0]), beside))
    return df.withColumn(into, F.concat(*(F.col(base[k]) for k in BASE), secrets, added)).drop(pieces, *base.values())


def fit(found: DataFrame, into: str = "candidates", rounds: int = ROUNDS) -> list[str]:
    """The codes of added kinds that the classifier accepts, learned from all candidates of ``found``."""
    codes = found.select(F.explode(into).alias("c")).groupBy("c.code").agg(F.count("*").cast("double").alias("n"))
    codes = codes.withColumn("part", F.split("code", ":"))
    kind = F.array_position(F.lit(list(KINDS)), F.col("part")[0]).cast("int") - 1
    votes = F.transform(F.sequence(F.lit(0), F.lit(len(LABELERS) - 1)), lambda j: len(KINDS) + 3 * j + F.instr(F.lit("+-0"), F.col("part")[1].substr(j + 1, F.lit(1))) - 1)
    spots, low = [kind], len(KINDS)
    for i, values in enumerate(FEATURES):
        spots.append(F.instr(F.lit(values), F.col("part")[2].substr(i + 1, 1)) - 1 + low)
        low += len(values)
    codes = codes.select("code", "n", F.col("part")[0].alias("kind"), F.concat(F.array(kind), votes).alias("votes"), F.array(*spots).alias("features"))
    codes = common.stored(codes.coalesce(1), "pii-codes")
    codes = codes.withColumn("p", _sigmoid(_summed("votes", _trusted(codes, rounds))))
    accepted = _summed("features", _classifier(codes, low, rounds)) >= 0
    return [r["code"] for r in codes.filter(F.col("kind").isin(*ADDED) & accepted).select("code").collect()]


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _summed(spots: str, weights: list[float]) -> Column:
    """Sum of the weights at the places in an array column."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    return F.aggregate(spots, F.lit(0.0), lambda a, i: a + F.get(table, i))


def _by_spot(codes: DataFrame, spots: str, **sums: Column) -> dict:
    """{place: sums over the codes that have it}: a row for each labeler's vote, or feature, and kind."""
    rows = codes.select(F.explode(spots).alias("spot"), *(c.alias(k) for k, c in sums.items())).groupBy("spot").agg(*(F.sum(k).alias(k) for k in sums))
    return {r["spot"]: r for r in rows.collect()}


def _trusted(codes: DataFrame, rounds: int) -> list[float]:
    """Expectation-maximisation over the votes: what each kind, and each labeler's vote, adds to the logit."""
    # Prior counts (of the kind or vote where the candidate is personal data, and where not): a vote is right
    # four times of five, until the data say otherwise.
    prior = [(5.0, 5.0)] * len(KINDS) + [(8.0, 2.0), (2.0, 8.0), (5.0, 5.0)] * len(LABELERS)
    counts = prior
    for k in range(rounds + 1):
        worth = [math.log(yes / no) for yes, no in counts[:len(KINDS)]]
        for j in range(len(KINDS), len(prior), 3):
            yes, no = (sum(c[y] for c in counts[j:j + 3]) for y in (0, 1))
            worth += [math.log(c[0] / yes) - math.log(c[1] / no) for c in counts[j:j + 3]]
        if k < rounds:
            p = _sigmoid(_summed("votes", worth))
            seen = _by_spot(codes, "votes", yes=F.col("n") * p, no=F.col("n") * (1 - p))
            counts = [(a + (seen[i]["yes"] if i in seen else 0.0), b + (seen[i]["no"] if i in seen else 0.0)) for i, (a, b) in enumerate(prior)]
    return worth


def _classifier(codes: DataFrame, size: int, rounds: int) -> list[float]:
    """Weights of a logistic model of the span's features, fitted to the probabilities ``p``."""
    weights = [0.0] * size
    for _ in range(rounds):  # each weight by its own Newton step, damped by the number of feature groups
        q = _sigmoid(_summed("features", weights))
        seen = _by_spot(codes, "features", gap=F.col("n") * (F.col("p") - q), bend=F.col("n") * q * (1 - q))
        for i, r in seen.items():
            weights[i] += max(-2.0, min(2.0, (r["gap"] - weights[i]) / (r["bend"] + 1.0) / (1 + len(FEATURES))))
    return weights


def spans(candidates_col: str, accepted: list[str]) -> Column:
    """Base candidates and the accepted ones of added kinds, as (kind, start, end)."""
    good = lambda c: c["kind"].isin(*BASE) | (c["code"].isin(*accepted) if accepted else F.lit(False))
    return F.transform(F.filter(candidates_col, good), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))

    def joined(pieces: Column, spans: Column) -> Column:
        def shown(at: Column, s: Column) -> Column:
            return F.when(s["start"] >= at, F.concat(_between(pieces, at, s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(F.lit(""))
        reached = _running(F.transform(spans, lambda s: -s["back"]), lambda a, x: F.greatest(a, x))
        rest = _between(pieces, -F.array_min(F.transform(spans, lambda s: s["back"])), F.length(text))
        return F.concat(F.array_join(F.zip_with(reached, spans, shown), ""), rest)

    return F.when(F.size(found) > 0, _let(_pieces(text), lambda pieces: _let(ordered, lambda spans: joined(pieces, spans)))).otherwise(text)
