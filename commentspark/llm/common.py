"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentspark import session
from commentspark.session import small_batches

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table, whole, through Spark's reader (any store Spark reaches)."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def workers_see_package(spark: SparkSession) -> None:
    """Python workers started after this call find this package where the
    driver has it (a cluster installs the package, or ships it as a py-file)."""
    small_batches(spark)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the cluster's shared folder and read
    back: lineage ends there, and a lost executor costs a re-read only."""
    return session.materialize(df, f"llm-{name}")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet (inputs may carry any names)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches, rows: int = 512):
    """Small batches: what a task makes of one stays small whatever the texts' length."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def runs(batches, keys: list[str]):
    """The rows of each run of equal ``keys``, as Arrow tables, of batches sorted by them."""
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        n = table.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for key in keys:
            values = table.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        for low, high in zip(starts, starts[1:], strict=False):
            yield table.slice(low, high - low)
        held = table.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held


def block_pairs(members: DataFrame, blocks: str, block: str) -> DataFrame:
    """Each row once for every pair (i, j), i <= j, of the blocks of its group that its own block is in:
    all pairs of rows of a large group meet, spread over blocks x blocks / 2 tasks."""
    pair = F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda k: F.struct(
        F.least(k, F.col(block)).alias("i"), F.greatest(k, F.col(block)).alias("j")))
    return members.withColumn("pair", F.explode(pair)).withColumns({"i": F.col("pair.i"), "j": F.col("pair.j")}).drop("pair")


def local_roots(linked, ids):
    """Smallest id that each row reaches over the symmetric boolean matrix ``linked``."""
    import numpy as np

    roots = ids.copy()
    while True:
        best = np.minimum(roots, np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        if (best == roots).all():
            return roots
        roots = best


FILTER_BITS = 1 << 20


def bit_filter(hashes: DataFrame, name: str):
    """A test for Column of hashes (long): false only if the value is not among ``hashes[name]``.

    The filter is 2**20 bits however many values there are (the driver sees 16,384 longs at most); it thins a table
    out before the exact join with ``hashes``, and lets all through where values are many.
    """
    at = F.pmod(F.col(name), F.lit(FILTER_BITS))
    words = (hashes.select((at / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())
    filled = [0] * (FILTER_BITS // 64)
    for r in words:
        filled[r["word"]] = r["bits"]
    table = F.split(F.lit(",".join(map(str, filled))), ",").cast("array<bigint>")

    def test(value: Column) -> Column:
        spot = F.pmod(value, F.lit(FILTER_BITS))
        return F.call_function("shiftrightunsigned", F.get(table, (spot / 64).cast("int")), (spot % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test
