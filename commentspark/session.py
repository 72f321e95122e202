"""Session helpers: a session for local runs, the cluster's shared folder, and
tables written there.

Library operators never create a session; they take DataFrames.  Only the
test/bench entry points call :func:`get_spark`.
"""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import json
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Partitions that a scan of a text table is dealt to; unset on a cluster, where
# inputs have splits enough.  get_spark sets it, as the local tables are one row group each.
SCAN_PARTITIONS = "spark.commentspark.scanPartitions"

_WRITTEN: list[str] = []
_KEPT: list[str] = []


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "commentspark") -> SparkSession:
    """Session for tests, bench and local runs (AQE on, UTC, no UI)."""
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("SPARK_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config(SCAN_PARTITIONS, str(parts))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Rows that readers and Python workers get at once.  Texts may be long: the defaults (4096 and 10000) hold
#: hundreds of megabytes of them, and of their tokens, in a task.
SMALL_BATCHES = {"spark.sql.parquet.columnarReaderBatchSize": ("4096", "512"), "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "500")}


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch sizes where it still has Spark's defaults."""
    for name, (default, rows) in SMALL_BATCHES.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, rows)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting names a shared, fault-tolerant folder and is
    used as is; without it nothing is written.  Only a local master, whose one
    process is driver and executor, gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="commentspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/tables/" + name


def fresh_path(spark: SparkSession, name: str) -> str:
    """A shared folder that no other call gets; :func:`drop_written` removes it."""
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    if not _WRITTEN:
        atexit.register(_drop_at_exit, spark, _WRITTEN)
    _WRITTEN.append(path)
    return path


def drop_written(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove the intermediate tables written so far.  Frames that read them
    must have been consumed: callers do it between queries, and it happens at exit."""
    paths = _WRITTEN if paths is None else paths
    if spark.sparkContext._jvm is None:
        return
    while paths:
        delete_path(spark, paths.pop())


def _drop_at_exit(spark: SparkSession, paths: list[str]) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by now
        drop_written(spark, paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority that Spark's default file system gives it."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, by Spark's file systems."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def kept(spark: SparkSession, name: str, inputs: list[str], build: Callable[[str], None]) -> str:
    """The folder that ``build`` filled from the ``inputs`` as they are now (their files' paths, sizes and times), built
    on the first call only.  It stays until the application ends, unlike the tables of one query."""
    state = []
    for path in inputs:
        fs, p = _fs(spark, path)
        state += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)]
    key = hashlib.md5(json.dumps([inputs, sorted(state)]).encode()).hexdigest()[:16]
    path = shared_path(spark, f"kept-{name}-{key}")
    if not path_exists(spark, path + "/_done"):
        delete_path(spark, path)
        if not _KEPT:
            atexit.register(_drop_at_exit, spark, _KEPT)
        _KEPT.append(path)
        build(path)
        write_note(spark, path + "/_done", "")
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts lineage, survives executor loss, and later scans get column
    pruning and filter pushdown.  Each call writes a fresh folder."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def workers_see_package(spark: SparkSession) -> None:
    """Python workers started after this call find this package where the
    driver has it (a cluster installs the package, or ships it as a py-file)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


def constant_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small constant table built JVM-side (``inline`` of a literal array of
    structs): no Python workers are needed to scan it."""
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema)
    structs = []
    for r in rows:
        fields = []
        for v, f in zip(r, st.fields):
            if isinstance(v, (list, tuple)):
                lit = F.array(*[F.lit(x) for x in v]).cast(f.dataType) if v else F.array().cast(f.dataType)
            else:
                lit = F.lit(v).cast(f.dataType)
            fields.append(lit.alias(f.name))
        structs.append(F.struct(*fields))
    return spark.range(1).select(F.inline(F.array(*structs)))
