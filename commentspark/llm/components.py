"""Connected components of an edge table, by alternating stars.

Each round hangs every larger neighbour of a node on the node's smallest neighbour
(large star), then every smaller neighbour likewise (small star); edges only ever move
towards smaller ids, and after a number of rounds that grows with the logarithm of the
longest path every node hangs on the smallest id of its component.  A round is two
aggregations and two joins on the node, all of which Spark partitions; the minima are
aggregated before they are shuffled and a hub's edges are split by AQE's skew join.
Each round is a table in the shared folder, so lineage does not grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node with an edge, and the smallest node it reaches.

    Null ends and loops are no edges; direction and repetition do not matter.
    """
    first = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    stars = edges.filter(F.col(a) != F.col(b)).select(*first).distinct()
    before = None
    while True:
        stars = common.stored(stars, "stars")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return (stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
        before = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = (both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(lowest, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(lowest.select("u", F.col("low").alias("v"))))
        stars = small.distinct()
