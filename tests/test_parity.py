"""Spark plans vs their DuckDB twins at sf0.001 (the driver repeats this at sf0.01)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from commentspark.sources.tables import TABLES  # noqa: E402
from commentspark.plans import catalog  # noqa: E402
from commentspark.session import drop_written  # noqa: E402
from tools.parity import _hash  # noqa: E402

catalog.load_all()

SF = "/root/testdata/sf0.001"
# The training-data operators have their own tests.
TWINS = sorted(name for name, sql in catalog.ORACLE.items())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", TWINS)
def test_twin(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    drop_written(spark)
    rel = con.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert _hash(df.columns, rows)[0] == _hash(rel.columns, drows)[0]


def test_entry_runs(spark):
    assert E.entry(spark).count() == 50
