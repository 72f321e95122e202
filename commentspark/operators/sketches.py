"""Mergeable distinct counts (A2, A21): a HyperLogLog sketch per group, kept as a table.

Sketches of groups, days or loads merge into those of any larger whole, so a report over stored
sketches reads a few kilobytes per group and no data again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Registers of a sketch, as a power of two.
LG_REGISTERS = 14


def error_bound(lg_registers: int = LG_REGISTERS, deviations: float = 3.0) -> float:
    """The relative error that an estimate stays within but for one in hundreds: that many standard errors of 1.04 / sqrt(registers)."""
    return deviations * 1.04 / math.sqrt(1 << lg_registers)


def sketched(df: DataFrame, by: list[str], item: Column, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """(by, sketch, n): the items of each group, null ones left out, and the number of rows."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(item, lg_registers).alias("sketch"), F.count(F.lit(1)).alias("n"))


def keep(df: DataFrame, path: str) -> None:
    """Add sketches to the table at ``path``."""
    df.write.mode("append").parquet(path)


def kept(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, n_distinct, n) of sketches merged by other columns (none: into one row)."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"), F.sum("n").alias("n"))
