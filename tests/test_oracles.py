"""Every query against its SQL, on the smallest test tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracles import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, tables, name):
    got = queries()[name](spark, FOLDER).toPandas()
    if name in oracle_sql():
        assert compare(got, tables.sql(oracle_sql()[name]).df()) == "ok"
    else:
        assert len(got) > 0
