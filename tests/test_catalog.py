"""Every registered query against its SQL, at the smallest scale."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from millrace.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return repr(float(v))
    return str(v)


def _rows(pdf):
    pdf = pdf.reindex(sorted(pdf.columns), axis=1)
    return sorted(tuple(_cell(v) for v in r) for r in pdf.astype(object).itertuples(index=False))


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", ["logistic_baseline", "score_batch", "perm_importance", "clean_log"])
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 11
