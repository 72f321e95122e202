"""Ranking helpers: per-group top-n, min-max normalisation, vector math."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, partition_cols: list[str], order_cols: list[Column], n: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows per group, 1-based ``rank_col``.

    ``row_number() <= n`` right above the window lets Spark plan a partial
    ``WindowGroupLimit`` before the shuffle, so each map task sends at most
    ``n`` rows per group however large the group is.
    """
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def as_double_array(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("array<double>")


# F23 --------------------------------------------------------------------------
def dot(a: Column, b: Column) -> Column:
    prods = F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def sq_l2(a: Column, b: Column) -> Column:
    d = F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x)


def norm2(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: Column, b: Column, metric: str = "l2") -> Column:
    """Vector distance: ``l2`` (Euclidean), ``l2sq`` (squared), ``cosine``
    (1 - cosine similarity; null with a zero vector), ``ip`` (1 - inner product)."""
    if metric == "l2":
        return F.sqrt(sq_l2(a, b))
    if metric == "l2sq":
        return sq_l2(a, b)
    if metric == "cosine":
        return F.lit(1.0) - F.try_divide(dot(a, b), norm2(a) * norm2(b))
    if metric == "ip":
        return F.lit(1.0) - dot(a, b)
    raise ValueError("metric must be one of: l2, l2sq, cosine, ip")


def sql_distance(a: str, b: str, metric: str = "l2") -> str:
    a, b = f"CAST({a} AS DOUBLE[])", f"CAST({b} AS DOUBLE[])"
    sq = f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    dp = f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"
    if metric == "l2":
        return f"sqrt({sq})"
    if metric == "l2sq":
        return sq
    if metric == "cosine":
        na = f"sqrt(list_sum(list_transform({a}, lambda x: x * x)))"
        nb = f"sqrt(list_sum(list_transform({b}, lambda x: x * x)))"
        return f"(1.0 - {dp} / nullif({na} * {nb}, 0.0))"
    if metric == "ip":
        return f"(1.0 - {dp})"
    raise ValueError(metric)


# F14 --------------------------------------------------------------------------
def similarity_from_distance(d: Column, kind: Column | str) -> Column:
    """``l2 -> 1 - d^2/2``, otherwise ``1 - d``; clamped to [0, 1]."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    raw = F.when(kind == F.lit("l2"), F.lit(1.0) - d * d / F.lit(2.0)).otherwise(F.lit(1.0) - d)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))


def sql_similarity_from_distance(d: str, kind: str) -> str:
    return (f"greatest(0.0, least(1.0, CASE WHEN {kind} = 'l2' THEN 1.0 - ({d}) * ({d}) / 2.0 "
            f"ELSE 1.0 - ({d}) END))")
