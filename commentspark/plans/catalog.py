"""Registry of named plans: each §2 operator as a Spark query over the driver
tables plus (where SQL can express it) its DuckDB twin.

Every output column is cast to ``bigint``, ``double`` or ``string`` and
doubles are rounded, in both twins, so the two engines agree on schema and
on the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
# A twin may be a callable: it is built only when the SQL is asked for.
ORACLE: dict[str, str | Callable[[], str]] = {}


def register(name: str, sql: str | Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def typed(df: DataFrame, spec: list[tuple[str, str]], digits: int = 6) -> DataFrame:
    """Final projection: cast (and round doubles) in a fixed column order."""
    cols = []
    for name, kind in spec:
        c = F.col(name)
        if kind == "double":
            c = F.round(c.cast("double"), digits)
        else:
            c = c.cast(kind)
        cols.append(c.alias(name))
    return df.select(*cols)


def sql_typed(spec: list[tuple[str, str]], digits: int = 6) -> str:
    out = []
    for name, kind in spec:
        if kind == "double":
            out.append(f"round(CAST({name} AS DOUBLE), {digits}) AS {name}")
        elif kind == "bigint":
            out.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            out.append(f"CAST({name} AS VARCHAR) AS {name}")
    return ", ".join(out)


def load_all() -> None:
    """Import every plan module so its ``@register`` calls run."""
    from . import q_retrieval, q_stats, q_text, q_enrich, q_index, q_qa, q_eval  # noqa: F401
