"""Small scalar functions (F8-F10, F12, F15-F19) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------
ENTITY_JSON_CAP = 800
UNASSIGNED_TOPIC = "unassigned_topic"
INSUFFICIENT = "Data insufficient."
UNGROUNDED_MARKERS = ["based on my knowledge", "as an ai", "generally speaking", "outside the context"]
INT_RE = r"^[+-]?[0-9]+$"


# F8 -----------------------------------------------------------------------------
def safe_float(c: Column, default: float = 0.0) -> Column:
    return F.round(F.coalesce(c.try_cast("double"), F.lit(default)), 6)


# F9 -----------------------------------------------------------------------------
def safe_int(c: Column, default: int = -1) -> Column:
    """``int(x)`` semantics: integer strings parse, '3.0' does not; doubles
    truncate toward zero; NaN/NULL give the default."""
    nan = F.coalesce(F.isnan(c.try_cast("double")), F.lit(False))
    return F.when(nan, F.lit(default)).otherwise(F.coalesce(c.try_cast("long"), F.lit(default)))


def sql_safe_int_str(x: str, default: int = -1) -> str:
    return (f"coalesce(CASE WHEN regexp_full_match(trim({x}), '{INT_RE}') "
            f"THEN TRY_CAST(trim({x}) AS BIGINT) END, {default})")


def sql_safe_int_num(x: str, default: int = -1) -> str:
    return f"coalesce(CASE WHEN isnan({x}) THEN NULL ELSE TRY_CAST(trunc({x}) AS BIGINT) END, {default})"


# F10 ----------------------------------------------------------------------------
_ENTITY_LIST = "array<struct<text:string,label:string>>"


def entities_payload(entities: Column) -> Column:
    return F.to_json(entities)


def sanitize_json_list(raw: Column) -> Column:
    """Invalid JSON or a non-list -> ``'[]'``; otherwise the compact list."""
    is_list = F.ltrim(raw).startswith("[")
    parsed = F.when(is_list, F.from_json(raw, _ENTITY_LIST))
    return F.to_json(F.coalesce(parsed, F.array().cast(_ENTITY_LIST)))


def sql_sanitize_json_list(raw: str) -> str:
    return (f"CASE WHEN json_valid({raw}) AND json_type(CAST({raw} AS JSON)) = 'ARRAY' "
            f"THEN CAST(json(CAST({raw} AS JSON)) AS VARCHAR) ELSE '[]' END")


# F12 ----------------------------------------------------------------------------
def topic_label(terms: Column) -> Column:
    return F.when(F.coalesce(F.size(terms), F.lit(0)) <= 0, F.lit(UNASSIGNED_TOPIC)).otherwise(
        F.array_join(F.slice(terms, 1, 3), "_"))


# F15 / F16 ----------------------------------------------------------------------
def ungrounded_style(answer: Column) -> Column:
    low = F.lower(F.coalesce(answer, F.lit("")))
    return F.exists(F.array(*[F.lit(m) for m in UNGROUNDED_MARKERS]), lambda m: low.contains(m))


def sql_ungrounded_style(a: str) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({a}, '')), '{m}')" for m in UNGROUNDED_MARKERS) + ")"


def insufficient_flag(answer: Column, mode: str = "startswith", error: Column | None = None) -> Column:
    """1 when the answer is the fallback (CLI: startswith, dashboard:
    contains), 2 on error, else 0."""
    a = F.coalesce(answer, F.lit(""))
    hit = a.startswith(INSUFFICIENT) if mode == "startswith" else a.contains("Data insufficient")
    flag = F.when(hit, F.lit(1)).otherwise(F.lit(0))
    if error is not None:
        flag = F.when(error, F.lit(2)).otherwise(flag)
    return flag


# F17 ----------------------------------------------------------------------------
def excerpt(c: Column, n: int = 80) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def sql_excerpt(x: str, n: int = 80) -> str:
    return f"CASE WHEN length({x}) > {n} THEN left({x}, {n}) || '...' ELSE {x} END"


# F19 ----------------------------------------------------------------------------
def trailing_int(c: Column) -> Column:
    return F.element_at(F.split(c, " "), -1).try_cast("long")
