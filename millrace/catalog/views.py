"""Derived tables, as SQL that Spark and DuckDB both accept.

The given tables hold no NULLs, repeats or stray blanks; these views add them.
``{name}`` stands for a given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import load_parquet

_DIRTY = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
  CASE WHEN o_orderkey % 10 < 6 THEN NULL ELSE o_orderpriority END AS mostly_missing,
  1 AS constant_col
FROM {orders}"""


def _gappy(k: int) -> str:
    """One of many columns that depend on each other and lack values in rows of their own."""
    value = f"l_discount * {k % 9 + 1} + l_tax * {k % 4} + l_quantity * {k % 3} * 0.01E0"
    return f"CASE WHEN (l_orderkey + {k} * l_linenumber) % {3 + k % 7} = 0 THEN NULL ELSE {value} END AS f{k}"


#: Columns of the widest view.
GAPPY_COLUMNS = [f"f{k}" for k in range(60)]

VIEWS = {
    "gappy_lineitem": f"SELECT {', '.join(_gappy(k) for k in range(len(GAPPY_COLUMNS)))}\nFROM {{lineitem}}",
    "dirty_orders": f"{_DIRTY}\nUNION ALL\n{_DIRTY} WHERE o_orderkey % 50 = 0",
    "sparse_orders": """SELECT o_orderkey,
  CASE WHEN o_orderkey % 700 <> 350 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 3 = 0 OR o_orderkey < 50 THEN NULL ELSE o_orderstatus END AS o_orderstatus
FROM {orders}""",
    "raw_orders": """SELECT CAST(o_orderkey AS STRING) AS o_orderkey,
  CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END AS o_totalprice,
  CASE WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS o_orderdate,
  o_orderpriority
FROM {orders}""",
    "dirty_customer": """SELECT c_custkey,
  CASE WHEN c_custkey % 3 = 0 THEN concat('  ', c_mktsegment, ' ')
       WHEN c_custkey % 3 = 1 THEN lower(c_mktsegment)
       ELSE concat(c_mktsegment, '   seg') END AS c_mktsegment,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal
FROM {customer}""",
    "wide_lineitem": """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_extendedprice * 2 + 1 AS price_copy, l_quantity AS qty_same, 0.0E0 AS zero_col,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target
FROM {lineitem}""",
    "priced_orders": """SELECT o_totalprice AS price, o_orderpriority,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished
FROM {orders}""",
    "forecast_lineitem": """SELECT l_extendedprice AS actual,
  2100.0E0 * l_quantity AS forecast
FROM {lineitem}""",
    "labelled_documents": """SELECT l.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
    "event_runs": """SELECT concat('run-', CAST(user_id AS STRING)) AS run_id, event_id,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  ts AS ended_at
FROM {events}""",
}

_NAMES = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived view, lazily."""
    if name not in VIEWS:
        return load_parquet(spark, f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    used = {n: load_parquet(spark, f"{sf_dir}/{n}.parquet") for n in set(_NAMES.findall(text))}
    return spark.sql(text, **used)


def cte(*names: str) -> str:
    """A WITH clause defining the views for the SQL side."""
    return "WITH " + ",\n".join(f"{n} AS (\n{_NAMES.sub(r'\1', VIEWS[n])}\n)" for n in names)
