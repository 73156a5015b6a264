"""Every registered query beside its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, name):
    frame = contract.queries()[name](spark, SF_DIR)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert got[1]
    if name in contract.oracle_sql():
        result = db.execute(contract.oracle_sql()[name])
        want = rows([d[0] for d in result.description], result.fetchall())
        assert got[0] == want[0] and got[1] == want[1]


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    assert contract.entry(spark).columns == ["d", "indexes", "counts", "cId"]


@pytest.fixture(scope="module")
def folder_tables(spark, tmp_path_factory):
    """Documents and events as folders of several files, as larger tables come."""
    base = str(tmp_path_factory.mktemp("folders"))
    for name in ("documents", "events", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(3).write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.mark.parametrize("name", ["micro_batch_publish", "micro_batch_score", "streaming_filter_query"])
def test_streams_read_tables_that_are_folders(spark, db, folder_tables, name):
    frame = contract.queries()[name](spark, folder_tables)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(contract.oracle_sql()[name])
    assert got == rows([d[0] for d in result.description], result.fetchall())
