"""Table scans.  Reading Parquet through ``spark.read`` keeps Catalyst's
column pruning and filter pushdown: only the columns a plan uses are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import SCAN_PARTITIONS, small_batches

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Text tables whose per-row work (regex cleaning, tokenizing) is CPU heavy.
TEXT_KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table.  Where the session asks for it (local runs over files of
    one row group), text tables are dealt to that many partitions."""
    small_batches(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(SCAN_PARTITIONS, None)
    if parts and name in TEXT_KEYS:
        df = df.repartition(int(parts), TEXT_KEYS[name])
    return df
