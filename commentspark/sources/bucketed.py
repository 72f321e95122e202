"""Bucketed Parquet tables at a path: rows dealt to a fixed number of buckets by the hash of
their keys, under partition folders where asked, sorted within files.

Joins and aggregations on the keys read such a table as it lies, without an exchange.  The
layout is kept in a note beside the data, so a table is opened by its path alone, in any
session: it is registered as an external table of the session's catalog.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, path_exists, read_note, write_note

NOTE = "_layout.json"
#: Lets a join on (bucket key, more) keep the buckets' partitioning instead of asking for all its keys.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Layout:
    """``schema`` (DDL) lists partition columns last; ``order`` is the sort within a file."""
    schema: str
    keys: tuple[str, ...]
    buckets: int
    partitions: tuple[str, ...] = ()
    order: tuple[str, ...] = ()


def _name(path: str) -> str:
    return "commentspark_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def default_buckets(spark: SparkSession) -> int:
    """Buckets of a table that names none: as many as the session's shuffle partitions, but no more than four for each core of
    the cluster, as each bucket is a file of its own.  Larger tables are given their number."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{NOTE}")


def create(spark: SparkSession, path: str, layout: Layout) -> None:
    """An empty table at ``path``.  What a table there held goes; a folder that is no such table is an error."""
    if path_exists(spark, path):
        if not exists(spark, path):
            raise ValueError(f"{path} exists and is no bucketed table")
        delete_path(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    write_note(spark, f"{path}/{NOTE}", json.dumps(asdict(layout)))


def layout_of(spark: SparkSession, path: str) -> Layout:
    found = json.loads(read_note(spark, f"{path}/{NOTE}"))
    return Layout(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})


def _registered(spark: SparkSession, path: str) -> str:
    name = _name(path)
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)  # another session of the application may have written
        return name
    layout = layout_of(spark, path)
    columns = ", ".join(f"`{c}`" for c in layout.keys)
    order = f" SORTED BY ({', '.join(layout.order)})" if layout.order else ""
    parts = f" PARTITIONED BY ({', '.join(layout.partitions)})" if layout.partitions else ""
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({layout.schema}) USING parquet{parts} CLUSTERED BY ({columns}){order} "
              f"INTO {layout.buckets} BUCKETS LOCATION '{where}'")
    if layout.partitions:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as this application knows it; :func:`reopen` finds folders that others made since."""
    return spark.table(_registered(spark, path))


def reopen(spark: SparkSession, path: str) -> DataFrame:
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    return open_table(spark, path)


def dealt(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows shuffled as the table lies: each task holds whole buckets, so it writes one file per bucket and partition folder."""
    return df.repartition(layout.buckets, *layout.keys)


def append(df: DataFrame, path: str, overwrite_partitions: bool = False) -> None:
    """Add ``df``'s rows; ``overwrite_partitions`` replaces the partition folders they fall in, so a repeated write adds nothing."""
    spark = df.sparkSession
    name = _registered(spark, path)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=overwrite_partitions)


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's setting changed for the actions within."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def by_bucket(spark: SparkSession):
    """A context in which joins on a bucketed table's keys and others keep its buckets; run the query's action inside."""
    return setting(spark, CO_PARTITION, "false")


def as_it_lies(spark: SparkSession):
    """A context in which a bucketed table is read bucket by bucket even where only the writing that follows asks for it."""
    return setting(spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")


def forget(spark: SparkSession, path: str) -> None:
    """Take a table that is read no more out of the session's catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")


_SPREAD: dict[int, list[int]] = {}


def spread(spark: SparkSession, buckets: int) -> list[int]:
    """For each bucket a number that falls in it: values of an int key that fill all buckets evenly."""
    if buckets not in _SPREAD:
        _SPREAD[buckets] = _numbers(spark, buckets)
    return _SPREAD[buckets]


def _numbers(spark: SparkSession, buckets: int) -> list[int]:
    numbers = spark.range(buckets * 4 + 64)
    while True:
        at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(buckets))
        found = numbers.groupBy(at.alias("b")).agg(F.min("id").cast("int").alias("n")).collect()
        if len(found) == buckets:
            return [r["n"] for r in sorted(found, key=lambda r: r["b"])]
        numbers = spark.range(numbers.count() * 2)
