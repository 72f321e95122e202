"""Operator 7: near-duplicate vectors.

Random-hyperplane sign hashing in several tables, exact cosine verification in double
precision, distributed connected components.

Equal vectors are one representative with a count.  A representative gets one key in
each table, the signs of its products with that table's hyperplanes.  The vectors that
share a key are compared exactly, in blocks: a bucket of any size is cut into blocks and
each pair of blocks is a task of its own, which gives the number of links of each vector
and a local spanning forest, never the pairs.  A pair counts in the first table where its
keys agree, so it counts once.

``tables`` follows from ``bits`` and ``miss``: a pair exactly at the threshold stays
unfound with probability ``miss`` at most, closer pairs with far less.  ``bits`` follows
from the number of vectors, so that a bucket of unrelated vectors holds about
``BUCKET``.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component
links with nothing, and vectors of different dimensions do not link; each is its own
component.  Repeated rows are vectors of their own.  Rows with a null id are compared like
others; they count as links but give no component its name, and theirs is null.  An empty table gives no
rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import connected_components

THRESHOLD = 0.9
MISS = 1e-4
BUCKET = 64
#: Vectors of a block; a task compares two blocks.
BLOCK = 1_024
SEED = 20_241


def shape(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for n vectors."""
    bits = min(24, max(6, round(math.log2(max(n, 1) / BUCKET))))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(miss) / math.log1p(-(agree**bits)))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, miss: float = MISS, seed: int = SEED) -> DataFrame:
    """(id_col, n_links, component_id, kept), one row per input row."""
    spark = vectors.sparkSession
    common.workers_see_package(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.coalesce((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists("v", lambda x: x != 0), F.lit(False))
    # Adding 0 makes the two zeros one.
    rows = rows.withColumn("v", F.when(sound, F.transform("v", lambda x: x + F.lit(0.0))))
    rows = common.stored(rows.withColumn("twin", F.when(F.col("v").isNotNull(), F.xxhash64("v", F.lit(seed)))), "vectors")
    # A class is named by its hash: the vectors of one hash are compared, so a collision of unequal ones is told apart.
    classes = (rows.filter("v is not null").groupBy("twin", "v").agg(F.min("id").alias("low"), F.count("*").alias("copies")))
    classes = common.stored(classes.withColumn("rep", F.xxhash64("twin", "v")), "vector-classes")
    bits, tables = shape(classes.count(), threshold, miss)
    links = common.stored(_links(_keyed(classes, bits, tables, seed), threshold), "vector-links")

    degree = links.groupBy("rep").agg(F.sum("links").alias("linked"))
    components = connected_components(links, "rep", "root")
    named = (classes.select("rep", "low").join(components, F.col("rep") == F.col("node"), "left")
             .select("rep", "low", F.coalesce("component", "rep").alias("component")))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    facts = (classes.select("rep", "twin", "v", "copies").join(degree, "rep", "left")
             .join(named.join(lowest, "component").select("rep", "component_id"), "rep")
             .select("twin", "v", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id"))
    out = (rows.filter("v is not null").join(facts, ["twin", "v"]).select("id", "n_links", "component_id")
           .unionByName(rows.filter("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _keyed(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(rep, copies, v, sig): the keys of all tables; a key also depends on the dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits)
        for batch in batches:
            vectors = batch.column("v")
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy()
            sigs = np.zeros((len(sizes), tables), np.int32)
            ends = np.cumsum(sizes)
            for d in np.unique(sizes).tolist():
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).standard_normal((d, tables * bits))
                at = np.flatnonzero(sizes == d)
                x = flat[(ends[at] - d)[:, None] + np.arange(d)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                sigs[at] = (((x @ planes[d]) > 0).reshape(len(at), tables, bits) * weights).sum(axis=2)
            offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rep", "copies", "v")),
                                              pa.ListArray.from_arrays(offsets, pa.array(sigs.ravel()))], ["rep", "copies", "v", "sig"])

    return classes.select("rep", "copies", "v").mapInArrow(run, "rep long, copies long, v array<double>, sig array<int>")


def _links(keyed: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, root): for each task that found links of a representative, how many vectors it linked and
    the smallest representative that its links there reach."""
    keyed = common.stored(keyed, "vector-keys")
    keys = keyed.select("rep", F.size("v").alias("d"), F.posexplode("sig").alias("t", "key"))
    group = ["t", "key", "d"]
    sizes = keys.groupBy(*group).agg(F.count("*").alias("n")).filter("n > 1")
    members = (keys.join(sizes, group).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
               .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int")))
    pairs = common.block_pairs(members, "blocks", "block").select("rep", *group, "block", "i", "j")
    task = [*group, "i", "j"]
    rows = pairs.join(keyed, "rep").repartition(*task).sortWithinPartitions(*task)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group_rows in common.runs(batches, task):
            if group_rows.num_rows < 2:
                continue
            table = group_rows.column("t")[0].as_py()
            one = group_rows.combine_chunks().to_batches()[0]
            n = one.num_rows
            x = one.column("v").flatten().to_numpy().reshape(n, -1)
            norms = np.linalg.norm(x, axis=1)
            bad = ~np.isfinite(norms) | (norms == 0)
            if bad.any():  # squares beyond double range: the angle does not change with the length
                x = np.where(bad[:, None], x / np.abs(x).max(axis=1, keepdims=True), x)
                norms = np.linalg.norm(x, axis=1)
            block, i, j = one.column("block").to_numpy(), one.column("i")[0].as_py(), one.column("j")[0].as_py()
            linked = (x @ x.T) / norms[:, None] / norms[None, :] >= threshold
            np.fill_diagonal(linked, False)
            if i != j:
                linked &= block[:, None] != block[None, :]
            a, b = np.nonzero(linked)
            if not len(a):
                continue
            sig = one.column("sig").flatten().to_numpy().reshape(n, -1)
            for low in range(0, len(a), 65_536):
                part = slice(low, low + 65_536)
                linked[a[part], b[part]] = (sig[a[part]] == sig[b[part]]).argmax(axis=1) == table
            linked &= linked.T
            weights = one.column("copies").to_numpy()
            links, reps = linked @ weights, one.column("rep").to_numpy()
            roots = common.local_roots(linked, reps)
            there = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(reps[there]), pa.array(links[there]), pa.array(roots[there])], ["rep", "links", "root"])

    return rows.select("rep", "copies", "v", "sig", "block", *task).mapInArrow(run, "rep long, links long, root long")
