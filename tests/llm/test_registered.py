"""Registered queries against SQL, and the pipeline against its stages by hand."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.llm.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels".split()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{SMALL}/{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    found = entry.queries()[name](spark, SMALL)
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    want = sorted((tuple(r[columns.index(c)] for c in found.columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names
