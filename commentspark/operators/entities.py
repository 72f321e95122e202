"""Pattern entity extraction (X7) and the legacy entity-string parser (F20).

Entities are unique ``(text, label)`` pairs with a label whitelist.  The
neural tagger of the reference is not built; each label is a regex run with
``regexp_extract_all`` (row-local, no shuffle).  Pairs keep first-seen order
within a label, labels in pattern order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sql_strip_ws, strip_ws

ENTITY_STRUCT = "array<struct<text:string,label:string>>"

#: Patterns whose matches all hold an at sign: texts without one are not searched.
AT_SIGN = re.compile(r"^[^|]*\]\+@[^|?*{]*\[[^|]*$")

# --- fixed values: the labels kept by default ------------------------------------
ENTITY_LABELS = ("ORG", "PERSON", "PRODUCT", "GPE", "EVENT", "WORK_OF_ART", "FAC")

# --- fixed values: labels stripped from the legacy "X (LABEL)" form -------------
LEGACY_LABEL_SUFFIX = r" \((ORG|PERSON|PRODUCT|GPE)\)$"


def _labeller(label: str):
    # one-argument lambda: F.transform passes (element, index) to two-argument ones
    return lambda m: F.struct(strip_ws(m).alias("text"), F.lit(label).alias("label"))


def extract_entities(text: Column, patterns: list[tuple[str, str, int]],
                     labels: set[str] | None = None) -> Column:
    """``array<struct<text, label>>`` of distinct non-empty matches."""
    parts = []
    for label, pattern, group in patterns:
        if labels is not None and label not in labels:
            continue
        found = F.regexp_extract_all(text, F.lit(pattern), group)
        if AT_SIGN.search(pattern):
            found = F.when(text.contains("@"), found).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))
        parts.append(F.transform(found, _labeller(label)))
    if not parts:
        return F.array().cast(ENTITY_STRUCT)
    pairs = F.flatten(F.array(*parts))
    return F.array_distinct(F.filter(pairs, lambda e: e["text"] != F.lit("")))


def gazetteer_entities(docs: DataFrame, gazetteer: DataFrame, id_col: str, text_col: str, longest: int = 3,
                       labels: tuple[str, ...] = ENTITY_LABELS) -> DataFrame:
    """``(id, text, label)``: distinct names of a dictionary table
    ``(name, label)`` found in the text as runs of one to ``longest`` words.

    The word n-grams are joined to the dictionary on the lower-cased name, so the
    dictionary may be of any size: AQE broadcasts it where its bytes allow and
    splits frequent words otherwise."""
    words = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"[\p{L}\p{N}]++"), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), words.alias("w"))
    grams = [F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), _run_of(n)) for n in range(1, longest + 1)]
    grams = [F.when(F.size("w") >= n, g).otherwise(F.array().cast("array<string>")) for n, g in enumerate(grams, 1)]
    rows = rows.select("id", F.explode(F.array_distinct(F.concat(*grams))).alias("key"))
    names = gazetteer.where(F.col("label").isin(*labels)).select(F.lower("name").alias("key"), F.col("name").alias("text"), "label").distinct()
    return rows.join(names, "key").select("id", "text", "label")


def _run_of(n: int):
    return lambda i: F.array_join(F.slice("w", i, n), " ")


def legacy_entity_string(entities: Column) -> Column:
    """The ``"X (LABEL), Y (LABEL)"`` form older reports consumed."""
    return F.array_join(F.transform(entities, lambda e: F.concat(e["text"], F.lit(" ("), e["label"],
                                                                  F.lit(")"))), ", ")


def parse_legacy_entities(s: Column) -> Column:
    """split on ``", "`` and strip a trailing `` (ORG|PERSON|PRODUCT|GPE)``."""
    return F.transform(F.split(s, ", "), lambda x: F.regexp_replace(x, LEGACY_LABEL_SUFFIX, ""))


# --- SQL twins -------------------------------------------------------------------
def sql_entity_rows(text: str, patterns: list[tuple[str, str, int]]) -> str:
    """DuckDB list of structs ``{text, label}`` (order not guaranteed)."""
    parts = []
    for label, pattern, group in patterns:
        p = pattern.replace("'", "''")
        parts.append(f"list_transform(regexp_extract_all({text}, '{p}', {group}), "
                     f"lambda m: {{'text': {sql_strip_ws('m')}, 'label': '{label}'}})")
    allp = parts[0]
    for p in parts[1:]:
        allp = f"list_concat({allp}, {p})"
    return f"list_filter({allp}, lambda e: e.text <> '')"
