"""The registered queries again, as SQL a plain SQL engine runs on the tables."""

from __future__ import annotations

from millrace.catalog.views import GAPPY_COLUMNS, cte
from millrace.sources.tables import MISSING_MARKS

ORACLE: dict[str, str] = {}

# name, is-number, SQL type as the profile reports it
LINEITEM = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
ORDERS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
DIRTY_ORDERS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "mostly_missing": "string", "constant_col": "int",
}
WIDE_LINEITEM = {
    "l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
    "l_discount": "double", "l_tax": "double", "price_copy": "double", "qty_same": "double",
    "zero_col": "double", "target": "int",
}
FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
_NUMBERS = ("bigint", "int", "double")


def numbers(schema: dict[str, str]) -> list[str]:
    return [c for c, t in schema.items() if t in _NUMBERS]


def each(items, template: str) -> str:
    """UNION ALL of the template over names; {c} is the name."""
    return "\nUNION ALL\n".join(template.replace("{c}", str(c)) for c in items)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


# --- sources, quality ----------------------------------------------------

ORACLE["load_preview"] = "SELECT r_regionkey, r_name FROM region ORDER BY r_regionkey LIMIT 3"

_DUPES = "(SELECT count(*) FROM dirty_orders) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty_orders))"
_TOTAL = " + ".join(f"count(*) - count({c})" for c in DIRTY_ORDERS)
ORACLE["quality_profile"] = cte("dirty_orders") + each(
    DIRTY_ORDERS,
    f"""
SELECT '{{c}}' AS "column", count(*) AS rows, CAST({_DUPES} AS BIGINT) AS duplicates,
  count(*) - count({{c}}) AS missing, {_TOTAL} AS missing_total FROM dirty_orders""",
)
ORACLE["duplicate_count"] = cte("dirty_orders") + f"\nSELECT CAST({_DUPES} AS BIGINT) AS duplicates"
ORACLE["missing_counts"] = cte("dirty_orders") + each(
    DIRTY_ORDERS, '\nSELECT \'{c}\' AS "column", count(*) - count({c}) AS missing FROM dirty_orders'
)
ORACLE["validate_table"] = cte("dirty_orders") + f"""
SELECT 'not_empty' AS "check", count(*) > 0 AS passed FROM dirty_orders
UNION ALL SELECT 'has_columns', true
UNION ALL SELECT 'missing_share', ({_TOTAL}) / (count(*) * {len(DIRTY_ORDERS)}.0) <= 0.3 FROM dirty_orders
UNION ALL SELECT 'unique_names', true"""
ORACLE["dedup_full"] = cte("dirty_orders") + """
SELECT DISTINCT * REPLACE (CAST(o_custkey AS DOUBLE) AS o_custkey) FROM dirty_orders"""
ORACLE["dedup_keep_first"] = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
) WHERE rn = 1"""
ORACLE["numeric_summary"] = each(
    numbers(LINEITEM),
    """SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM lineitem""",
)


def _univariate(table: str, schema: dict[str, str]) -> str:
    moments = """SELECT '{c}' AS "column", round((count(*) - count({c})) / count(*), 4) AS missing_pct,
  count(DISTINCT {c}) AS n_unique, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max,
  CASE WHEN min({c}) = max({c}) THEN 0.0 ELSE round(skewness({c}), 4) + 0.0 END AS skew FROM """ + table
    plain = """SELECT '{c}' AS "column", round((count(*) - count({c})) / count(*), 4) AS missing_pct,
  count(DISTINCT {c}) AS n_unique, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,
  CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS skew FROM """ + table
    others = [c for c in schema if c not in numbers(schema)]
    return each(numbers(schema), moments) + "\nUNION ALL\n" + each(others, plain)


ORACLE["univariate"] = _univariate("lineitem", LINEITEM)
ORACLE["univariate_missing"] = cte("dirty_orders") + "\n" + _univariate("dirty_orders", DIRTY_ORDERS)


def _top(table: str, columns: list[str], k: int | None, keep_null: bool) -> str:
    limit = f"QUALIFY row_number() OVER (ORDER BY cnt DESC, value ASC NULLS LAST) <= {k}" if k else ""
    keep = "" if keep_null else "WHERE {c} IS NOT NULL"
    return each(
        columns,
        f"""SELECT * FROM (SELECT '{{c}}' AS "column", CAST({{c}} AS VARCHAR) AS value, count(*) AS cnt
  FROM {table} {keep} GROUP BY {{c}} {limit})""",
    )


ORACLE["top_categories"] = _top("part", ["p_name", "p_brand", "p_type"], 20, False)
ORACLE["value_counts"] = cte("dirty_orders") + "\n" + _top("dirty_orders", ["o_orderstatus", "mostly_missing"], 20, True)


def _outliers(table: str, columns: list[str]) -> str:
    return each(
        columns,
        f"""SELECT * FROM (
  SELECT '{{c}}' AS "column", count(*) FILTER (x < lo OR x > hi) AS cnt,
    round(100.0 * count(*) FILTER (x < lo OR x > hi) / count(*), 4) AS pct,
    round(any_value(lo), 4) AS lower_bound, round(any_value(hi), 4) AS upper_bound
  FROM (SELECT CAST({{c}} AS DOUBLE) AS x, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
    FROM {table}, (SELECT quantile_cont(CAST({{c}} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({{c}} AS DOUBLE), 0.75) AS q3 FROM {table}))
) WHERE cnt > 0""",
    )


ORACLE["outliers_iqr"] = _outliers("documents", ["doc_id", "n_chars"])
ORACLE["outliers_events"] = _outliers("events", ["event_id", "user_id", "value"])


def _roles(table: str, schema: dict[str, str]) -> str:
    parts = []
    for c, t in schema.items():
        unique = f"(SELECT count(DISTINCT {c}) >= 0.9 * count(*) FROM {table})"
        if t in _NUMBERS:
            parts += [f"SELECT '{c}' AS \"column\", 'numeric' AS role",
                      f"SELECT '{c}', 'boolean' WHERE (SELECT bool_and({c} IN (0, 1)) FROM {table})"]
        elif t == "string":
            wordy = f"(SELECT avg(length({c})) > 30 FROM {table})"
            parts += [f"SELECT '{c}' AS \"column\", 'text' AS role WHERE {wordy}",
                      f"SELECT '{c}', 'categorical' WHERE NOT {wordy} AND NOT {unique}"]
        else:
            parts.append(f"SELECT '{c}' AS \"column\", 'datetime' AS role")
        parts.append(f"SELECT '{c}', 'id' WHERE {unique}")
    return "\nUNION ALL\n".join(parts)


ORACLE["column_roles"] = _roles(
    "documents", {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
)
ORACLE["column_roles_orders"] = _roles("orders", ORDERS)
ORACLE["column_roles_labels"] = _roles("labels", {"doc_id": "bigint", "quality": "int", "toxic": "int"})
ORACLE["table_metadata"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS missing, count(*) AS rows,
  CAST({len(ORDERS)} AS BIGINT) AS columns FROM orders"""
    for c, t in ORDERS.items()
)
ORACLE["quality_delta"] = cte("dirty_orders") + f""", d AS (SELECT DISTINCT * FROM dirty_orders)
SELECT metric, before, after, before - after AS change FROM (
  SELECT 'rows' AS metric, (SELECT count(*) FROM dirty_orders) AS before, (SELECT count(*) FROM d) AS after
  UNION ALL SELECT 'duplicates', {_DUPES}, 0
  UNION ALL SELECT 'missing', (SELECT {_TOTAL} FROM dirty_orders), (SELECT {_TOTAL} FROM d))"""
ORACLE["insights"] = each(
    ["doc_id", "n_chars"],
    """SELECT '{c}' AS "column", 'highly_skewed' AS insight, round(s, 4) AS value
  FROM (SELECT skewness({c}) AS s FROM documents) WHERE abs(s) > 1""",
)
ORACLE["insights_missing"] = cte("dirty_orders") + f"""
SELECT '*' AS "column", 'missing_values' AS insight, CAST({_TOTAL} AS DOUBLE) AS value FROM dirty_orders"""
ORACLE["target_gate"] = """SELECT 'target_present' AS "check", true AS passed, 1.0::DOUBLE AS detail
UNION ALL SELECT 'target_varies', count(DISTINCT quality) >= 2, CAST(count(DISTINCT quality) >= 2 AS INT) FROM labels
UNION ALL SELECT 'target_null_share', 1 - count(quality) / count(*) <= 0.4, round(1 - count(quality) / count(*), 6) FROM labels"""
ORACLE["problem_type"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", u AS n_unique, """
    + (
        """CASE WHEN u < 10 THEN 'classification'
  WHEN u > 30 OR (u > 10 AND u / n > 0.05) THEN 'regression' ELSE 'classification' END"""
        if t in _NUMBERS else "'classification'"
    )
    + f" AS problem_type FROM (SELECT count(DISTINCT {c}) AS u, count(*) AS n FROM lineitem)"
    for c, t in LINEITEM.items()
)

# --- cleaning ------------------------------------------------------------

ORACLE["normalize_columns"] = """SELECT c_custkey AS cust_key, c_name AS cname, c_nationkey AS nation_key,
  c_acctbal AS acctbal_, c_mktsegment AS mkt_segment FROM customer"""
_TYPED = """
SELECT try_cast(o_orderkey AS DOUBLE) AS o_orderkey, try_cast(o_totalprice AS DOUBLE) AS o_totalprice,
  try_cast(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority FROM raw_orders"""
ORACLE["apply_schema"] = cte("raw_orders") + _TYPED
ORACLE["correct_types"] = cte("raw_orders") + _TYPED
ORACLE["detect_types"] = cte("raw_orders") + each(
    ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"],
    r"""
SELECT '{c}' AS "column", CASE WHEN d > 0.5 THEN 'datetime' WHEN x > 0.8 THEN 'numeric' ELSE 'text' END AS suggestion,
  round(d, 6) AS date_frac, round(x, 6) AS num_frac
FROM (SELECT count(*) FILTER (regexp_full_match({c}, '\d{4}-\d{2}-\d{2}') AND try_cast({c} AS DATE) IS NOT NULL) / count(*) AS d,
  count(try_cast({c} AS DOUBLE)) / count(*) AS x FROM raw_orders)""",
)
ORACLE["standardize_text"] = cte("dirty_customer") + r"""
SELECT c_custkey, lower(trim(regexp_replace(c_mktsegment, '\s+', ' ', 'g'))) AS c_mktsegment FROM dirty_customer"""


def _excluded(table: str, key: str, schema: dict[str, str], target: str | None) -> str:
    parts = []
    for c, t in schema.items():
        if c == target:
            parts.append(f"SELECT '{c}' AS \"column\", 'target' AS reason")
        elif c.endswith("id") or c.startswith("id_"):
            parts.append(f"SELECT '{c}' AS \"column\", 'id_name' AS reason")
        else:
            hashy = f"""(SELECT bool_or(regexp_matches(CAST({c} AS VARCHAR), '(?i)([a-f0-9]{{8,}}|[A-Z0-9-]{{12,}})'))
  FROM (SELECT {c} FROM {table} ORDER BY {key} LIMIT 10))"""
            parts.append(f"SELECT '{c}' AS \"column\", 'id_values' AS reason WHERE {hashy}")
            if t != "double":
                many = f"(SELECT count(*) > 10 AND count(DISTINCT {c}) / count(*) > 0.95 FROM {table})"
                parts.append(f"SELECT '{c}', 'id_share' WHERE {many} AND NOT {hashy}")
    return "\nUNION ALL\n".join(parts)


ORACLE["exclude_columns"] = _excluded("orders", "o_orderkey", ORDERS, "o_orderstatus")
ORACLE["exclude_columns_documents"] = _excluded(
    "documents", "doc_id",
    {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}, None,
)
ORACLE["drop_id_named"] = cte("labelled_documents") + """
SELECT lang, source, n_chars, quality, toxic FROM labelled_documents"""


def _constant(table: str, schema: dict[str, str]) -> str:
    return each(
        schema,
        f"""SELECT '{{c}}' AS "column", count(DISTINCT {{c}}) AS n_unique, count(DISTINCT {{c}}) > 1 AS kept FROM {table}""",
    )


ORACLE["drop_constant"] = cte("dirty_orders") + "\n" + _constant("dirty_orders", DIRTY_ORDERS)
ORACLE["drop_constant_wide"] = cte("wide_lineitem") + "\n" + _constant("wide_lineitem", WIDE_LINEITEM)
ORACLE["encode_target"] = """SELECT o_orderkey,
  dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS target FROM orders"""
_MODE = """(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""


def _mode(table: str, column: str) -> str:
    return _MODE.replace("{c}", column).replace("{t}", table)


ORACLE["encode_target_missing"] = cte("dirty_orders") + f"""
SELECT o_orderkey, dense_rank() OVER (ORDER BY coalesce(o_orderstatus, {_mode("dirty_orders", "o_orderstatus")})) - 1 AS target
FROM dirty_orders"""
_ONE_HOT = """
SELECT o_orderkey, coalesce(o_orderstatus = 'O', false) AS "o_orderstatus_O",
  coalesce(o_orderstatus = 'P', false) AS "o_orderstatus_P" FROM """
ORACLE["one_hot"] = _ONE_HOT + "orders"
ORACLE["one_hot_missing"] = cte("dirty_orders") + _ONE_HOT + "dirty_orders"
ORACLE["scale_standard"] = """SELECT c_custkey,
  round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal_scaled
FROM customer"""
ORACLE["scale_minmax"] = """SELECT c_custkey,
  round((c_acctbal - (SELECT min(c_acctbal) FROM customer)) / (SELECT max(c_acctbal) - min(c_acctbal) FROM customer), 6) AS c_acctbal_scaled
FROM customer"""
ORACLE["business_rules_flag"] = cte("dirty_customer") + """,
clipped AS (SELECT c_acctbal AS was, CASE WHEN c_acctbal >= 9000 THEN 9000 ELSE c_acctbal END AS x FROM dirty_customer),
kept AS (SELECT x FROM clipped WHERE NOT coalesce(x <= 500, false))
SELECT 'c_acctbal >= 0.0' AS rule, 'flag' AS action, count(*) FILTER (was < 0) AS violations FROM clipped
UNION ALL SELECT 'c_acctbal < 9000.0', 'clip', count(*) FILTER (was >= 9000) FROM clipped
UNION ALL SELECT 'c_acctbal > 500.0', 'drop', count(*) FILTER (x <= 500) FROM clipped
UNION ALL SELECT 'c_acctbal <= 8000.0', 'flag', count(*) FILTER (x > 8000) FROM kept
UNION ALL SELECT 'c_acctbal == 9000.0', 'flag', count(*) FILTER (x IS DISTINCT FROM 9000) FROM kept"""
ORACLE["business_rules_drop"] = cte("dirty_customer") + """
SELECT * FROM dirty_customer WHERE c_acctbal >= 0 OR c_acctbal IS NULL"""
ORACLE["business_rules_clip"] = cte("dirty_customer") + """
SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM dirty_customer"""
_IMPUTED = f"""
SELECT o_orderkey,
  round(coalesce(CAST(o_custkey AS DOUBLE), (SELECT quantile_cont(CAST(o_custkey AS DOUBLE), 0.5) FROM dirty_orders)), 4) AS o_custkey,
  coalesce(o_orderstatus, {_mode("dirty_orders", "o_orderstatus")}) AS o_orderstatus,
  round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM dirty_orders)), 4) AS o_totalprice,
  coalesce(o_orderdate, {_mode("dirty_orders", "o_orderdate")}) AS o_orderdate,
  constant_col FROM dirty_orders"""
ORACLE["impute_missing"] = cte("dirty_orders") + _IMPUTED
ORACLE["clean_readable"] = cte("dirty_orders") + f""", filled AS ({_IMPUTED})
SELECT DISTINCT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate FROM filled"""
_CARRIED = ", ".join(
    f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    f"first_value({c} IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
    for c in ("o_custkey", "o_orderstatus")
)
ORACLE["fill_ordered"] = cte("sparse_orders") + f"""
SELECT o_orderkey, {_CARRIED} FROM sparse_orders"""
ORACLE["fill_zero"] = cte("dirty_orders") + """
SELECT o_orderkey, coalesce(o_custkey, 0) AS o_custkey, coalesce(o_totalprice, 0) AS o_totalprice FROM dirty_orders"""

# --- association ---------------------------------------------------------


def _r(a: str, b: str, digits: int = 6) -> str:
    safe = f"CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN corr({a}, {b}) END"
    return f"round({safe}, {digits}) + 0.0"


def _pairs(names: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]


ORACLE["corr_pairs"] = (
    cte("wide_lineitem") + "\nSELECT * FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_r(a, b)} AS r FROM wide_lineitem"
        for a, b in _pairs(numbers(WIDE_LINEITEM))
    )
    + "\n) WHERE abs(r) >= 0.3"
)


def _matrix(table: str, names: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_r(a, b)} AS r FROM {table}" for a in names for b in names
    )




def _gappy_pair(a: str, b: str) -> str:
    n = f"count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END)"
    return f"{{'col_a': '{a}', 'col_b': '{b}', 'n': {n}, 'r': round(corr({a}, {b}), 6) + 0.0}}"


ORACLE["corr_wide"] = (
    cte("gappy_lineitem") + f"\nSELECT unnest([{', '.join(_gappy_pair(a, b) for a, b in _pairs(GAPPY_COLUMNS))}], recursive := true) FROM gappy_lineitem"
)
ORACLE["corr_matrix"] = _matrix("lineitem", numbers(LINEITEM))
ORACLE["corr_matrix_missing"] = cte("dirty_orders") + "\n" + _matrix("dirty_orders", numbers(DIRTY_ORDERS))
ORACLE["target_correlations"] = cte("wide_lineitem") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", {_r(c, 'l_extendedprice', 3)} AS r FROM wide_lineitem" for c in numbers(WIDE_LINEITEM)
)
ORACLE["cat_num_stats"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS cat, {c} AS key, '{n}' AS num, round(avg({n}), 4) AS mean, count({n}) AS cnt FROM orders GROUP BY {c}"""
    for c in ("o_orderstatus", "o_orderpriority") for n in numbers(ORDERS)
)


def _grid(table: str, a: str, b: str) -> str:
    return f"""SELECT v1, v2, count(t.a) AS cnt FROM (SELECT DISTINCT {a} AS v1 FROM {table})
CROSS JOIN (SELECT DISTINCT {b} AS v2 FROM {table})
LEFT JOIN (SELECT {a} AS a, {b} AS b FROM {table}) t ON t.a = v1 AND t.b = v2 GROUP BY v1, v2"""


ORACLE["crosstab"] = _grid("lineitem", "l_returnflag", "l_linestatus")
ORACLE["crosstab_sparse"] = _grid("documents", "lang", "source")
ORACLE["contingency_cells"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {a} AS v1, {b} AS v2, count(*) AS cnt FROM part GROUP BY {a}, {b}"
    for a, b in (("p_brand", "p_type"), ("p_name", "p_brand"), ("p_name", "p_type"))
)


def _chi2(table: str, a: str, b: str) -> str:
    """One row (n, r, k, dof, chi2); the full grid, empty cells included."""
    return f"""(SELECT any_value(n) AS n, any_value(r) AS r, any_value(k) AS k, any_value((r - 1) * (k - 1)) AS dof,
  CASE WHEN any_value((r - 1) * (k - 1)) = 0 THEN 0.0
    WHEN any_value((r - 1) * (k - 1)) = 1 THEN sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e)
    ELSE sum(pow(o - e, 2) / e) END AS chi2
FROM (SELECT cnt AS o, n, r, k, CAST(sum(cnt) OVER (PARTITION BY v1) AS DOUBLE) * sum(cnt) OVER (PARTITION BY v2) / n AS e
  FROM (SELECT g.*, CAST(sum(cnt) OVER () AS DOUBLE) AS n,
      (SELECT count(DISTINCT {a}) FROM {table}) AS r, (SELECT count(DISTINCT {b}) FROM {table}) AS k
    FROM ({_grid(table, a, b)}) g)))"""


def _cramers(table: str, a: str, b: str) -> str:
    return f"""SELECT '{a}' AS col_a, '{b}' AS col_b,
  round(sqrt(chi2 / n / greatest(1, least(r - 1, k - 1))), 6) AS v FROM {_chi2(table, a, b)}"""


ORACLE["cramers_v"] = _cramers("orders", "o_orderstatus", "o_orderpriority")
ORACLE["cramers_v_lineitem"] = "\nUNION ALL\n".join(
    _cramers("lineitem", a, b)
    for a, b in (("l_returnflag", "l_linestatus"), ("l_returnflag", "l_linenumber"), ("l_linestatus", "l_linenumber"))
)
ORACLE["cramers_v_documents"] = _cramers("documents", "lang", "source")


def _mi(bin_x: str, bin_y: str) -> str:
    return f"""SELECT '{{c}}' AS feature, round(sum(c / n * ln(c * n / (cx * cy))), 6) AS mi FROM (
  SELECT CAST(cnt AS DOUBLE) AS c, CAST(sum(cnt) OVER () AS DOUBLE) AS n,
    CAST(sum(cnt) OVER (PARTITION BY bx) AS DOUBLE) AS cx, CAST(sum(cnt) OVER (PARTITION BY bz) AS DOUBLE) AS cy
  FROM (SELECT {bin_x} AS bx, {bin_y} AS bz, count(*) AS cnt FROM lineitem GROUP BY 1, 2))"""


def _width_bin(c: str, bins: int, table: str = "lineitem") -> str:
    low, high = f"(SELECT CAST(min({c}) AS DOUBLE) FROM {table})", f"(SELECT CAST(max({c}) AS DOUBLE) FROM {table})"
    return f"least({bins - 1}, CAST(floor(({c} - {low}) / (({high} - {low}) / {bins})) AS BIGINT))"


def _quantile_bin(c: str, bins: int) -> str:
    cuts = ", ".join(f"{i / bins}" for i in range(1, bins))
    edges = f"(SELECT list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{cuts}])) FROM lineitem)"
    return f"len(list_filter({edges}, lambda v: {c} > v))"


ORACLE["mutual_info"] = "\nUNION ALL\n".join(
    _mi(_width_bin(c, 16), _width_bin("l_extendedprice", 16)).replace("{c}", c) for c in FEATURES
)
ORACLE["mutual_info_quantile"] = "\nUNION ALL\n".join(
    _mi(_quantile_bin(c, 8), _quantile_bin("l_extendedprice", 8)).replace("{c}", c) for c in FEATURES
)
ORACLE["target_numeric_profile"] = """SELECT 'o_totalprice' AS target, 'double' AS dtype,
  round(1 - count(o_totalprice) / count(*), 4) AS missing_pct, count(DISTINCT o_totalprice) AS n_unique,
  round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, round(min(o_totalprice), 4) AS min,
  round(max(o_totalprice), 4) AS max, round(skewness(o_totalprice), 4) + 0.0 AS skew FROM orders"""

# --- tests ---------------------------------------------------------------

TERMS = 2000


def _beta(x: str, a: str, b: str) -> str:
    """1 - I_x(a, b) as a power series."""
    return f"""CASE WHEN {x} <= 0 THEN 1.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, {TERMS}), lambda k:
  exp(lgamma({a} + {b} + k) - lgamma({a} + k + 1) - lgamma({b}) + ({a} + k) * ln({x}) + {b} * ln(1 - {x}))))) END"""


def _gamma(x: str, dof: str) -> str:
    return f"""CASE WHEN {dof} = 0 OR {x} <= 0 THEN 1.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, {TERMS}), lambda k:
  exp(({dof} / 2.0 + k) * ln({x} / 2.0) - {x} / 2.0 - lgamma({dof} / 2.0 + k + 1))))) END"""


def _t_p(t: str, dof: str) -> str:
    return _beta(f"({t} * {t} / ({dof} + {t} * {t}))", "0.5", f"({dof} / 2.0)")


def _welch(table: str, value: str, by: str, feature: str, digits: int = 6) -> str:
    return f"""SELECT '{feature}' AS feature, round(t, {digits}) AS t, round(dof, {digits}) AS dof,
  round({_t_p("t", "dof")}, {digits}) AS p_value, {_t_p("t", "dof")} < 0.05 AS significant
FROM (SELECT (m[1] - m[2]) / sqrt(s[1] + s[2]) AS t,
    pow(s[1] + s[2], 2) / (pow(s[1], 2) / (n[1] - 1) + pow(s[2], 2) / (n[2] - 1)) AS dof
  FROM (SELECT list(m ORDER BY k) AS m, list(v / n ORDER BY k) AS s, list(n ORDER BY k) AS n
    FROM (SELECT {by} AS k, avg({value}) AS m, var_samp({value}) AS v, count({value}) AS n FROM {table} GROUP BY {by})))"""


ORACLE["welch_ttest"] = _welch("lineitem", "l_extendedprice", "l_linestatus", "l_linestatus")
ORACLE["welch_by_target"] = cte("wide_lineitem") + "\n" + "\nUNION ALL\n".join(
    _welch("wide_lineitem", c, "target", c) for c in ("l_quantity", "l_discount", "l_tax")
)
_F_P = _beta("(df1 * f / (df2 + df1 * f))", "(df1 / 2.0)", "(df2 / 2.0)")
ORACLE["anova"] = each(
    ["o_orderstatus", "o_orderpriority"],
    f"""SELECT '{{c}}' AS feature, round(f, 6) AS f, df1, df2, round({_F_P}, 6) AS p_value, {_F_P} < 0.05 AS significant
FROM (SELECT (ssb / (g - 1)) / (ssw / (n - g)) AS f, g - 1 AS df1, n - g AS df2 FROM (
  SELECT count(*) AS g, CAST(sum(c) AS BIGINT) AS n, sum(c * pow(m - grand, 2)) AS ssb, sum(v * (c - 1)) AS ssw
  FROM (SELECT count(o_totalprice) AS c, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v,
      (SELECT avg(o_totalprice) FROM orders) AS grand FROM orders GROUP BY {{c}})))""",
)
ORACLE["class_balance"] = """SELECT class, cnt, round(share, 6) AS share, round(max(cnt) OVER () / min(cnt) OVER (), 6) AS imbalance,
  CASE WHEN min(share) OVER () BETWEEN 0.45 AND 0.55 THEN 'Balanced'
    WHEN min(share) OVER () >= 0.2 AND min(share) OVER () < 0.45 THEN 'Moderately Imbalanced'
    ELSE 'Highly Imbalanced' END AS label
FROM (SELECT event_type AS class, count(*) AS cnt, count(*) / (SELECT count(*) FROM events) AS share FROM events GROUP BY event_type)"""


def _chi2_test(table: str, feature: str, target: str, digits: int = 6) -> str:
    return f"""SELECT '{feature}' AS feature, round(chi2, {digits}) AS chi2, dof, round({_gamma("chi2", "dof")}, {digits}) AS p_value,
  {_gamma("chi2", "dof")} < 0.05 AS significant FROM {_chi2(table, feature, target)}"""


ORACLE["chi2_independence"] = "\nUNION ALL\n".join(
    _chi2_test("lineitem", c, "l_returnflag") for c in ("l_linestatus", "l_linenumber", "l_discount")
)
ORACLE["chi2_labels"] = _chi2_test("labels", "quality", "toxic")
ORACLE["leakage_report"] = cte("wide_lineitem") + "\nSELECT * FROM (\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", 'high_correlation' AS issue, {_r(c, "l_quantity")} AS value FROM wide_lineitem"""
    for c in numbers(WIDE_LINEITEM) if c != "l_quantity"
) + "\n) WHERE abs(value) >= 0.95\nUNION ALL\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}', 'identical', NULL WHERE (SELECT bool_and({c} IS NOT DISTINCT FROM l_quantity) FROM wide_lineitem)"""
    for c, t in WIDE_LINEITEM.items() if t == "double" and c != "l_quantity"
)


def _pearson(feature: str, target: str, digits: int = 6) -> str:
    p = _t_p("t", "(n - 2)")
    return f"""SELECT '{feature}' AS feature, round(r, {digits}) AS r, n, round({p}, {digits}) AS p_value,
  CASE WHEN r > 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS direction, {p} < 0.05 AS significant
FROM (SELECT r, n, r * sqrt((n - 2) / (1 - r * r)) AS t
  FROM (SELECT corr({feature}, {target}) AS r, count(*) AS n FROM lineitem WHERE {feature} IS NOT NULL AND {target} IS NOT NULL))"""


ORACLE["pearson_pvalue"] = "\nUNION ALL\n".join(_pearson(c, "l_extendedprice") for c in FEATURES)

# --- evidence ------------------------------------------------------------

ORACLE["driver_correlations"] = (
    "WITH coded AS (SELECT *, dense_rank() OVER (ORDER BY l_returnflag) - 1 AS y FROM lineitem)\n"
    + each(
        FEATURES,
        """SELECT '{c}' AS feature, round(corr({c}, y), 6) AS r,
  CASE WHEN corr({c}, y) > 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS direction FROM coded""",
    )
)
_BUCKETS = """buckets AS (SELECT lineitem.*, CASE WHEN l_extendedprice <= q[1] THEN 'Q1 (Low)' WHEN l_extendedprice <= q[2] THEN 'Q2'
  WHEN l_extendedprice <= q[3] THEN 'Q3' ELSE 'Q4 (High)' END AS bucket
  FROM lineitem, (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM lineitem))"""
ORACLE["quartile_means"] = with_(_BUCKETS) + "\n" + each(
    FEATURES, "SELECT '{c}' AS feature, bucket, round(avg({c}), 4) AS mean FROM buckets GROUP BY bucket"
)
ORACLE["driver_quartiles"] = each(
    ["l_quantity", "l_extendedprice"],
    """SELECT '{c}' AS feature, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.75), 4) AS q3 FROM lineitem""",
)
ORACLE["class_means"] = each(
    FEATURES, "SELECT '{c}' AS feature, l_returnflag AS class, round(avg({c}), 4) AS mean FROM lineitem GROUP BY l_returnflag"
)
ORACLE["category_rates"] = cte("labelled_documents") + each(
    ["lang", "source"],
    """
SELECT '{c}' AS feature, {c} AS category, CAST(quality AS VARCHAR) AS class,
  round(count(*) / sum(count(*)) OVER (PARTITION BY {c}), 6) AS rate FROM labelled_documents GROUP BY {c}, quality""",
)
ORACLE["category_target_means"] = cte("labelled_documents") + each(
    ["lang", "source"],
    """
SELECT '{c}' AS feature, {c} AS category, round(avg(n_chars), 4) AS mean, count(n_chars) AS cnt FROM labelled_documents GROUP BY {c}""",
)
ORACLE["financial_impact"] = cte("priced_orders") + """
SELECT 'price' AS value_column, count(*) AS n, round(avg(finished), 6) AS target_mean, round(avg(price), 4) AS avg_value,
  round(count(*) * avg(finished) * avg(price), 1) AS impact FROM priced_orders"""
_EVIDENCE_ROWS = "\nUNION ALL\n".join(
    f"""SELECT feature, 'numeric' AS kind, 'pearson_r' AS statistic, round(r, 4) AS value, round(p_value, 4) AS p_value, significant
FROM ({_pearson(c, "l_extendedprice", 15)})
UNION ALL SELECT '{c}', 'numeric', concat('mean[', bucket, ']'), round(avg({c}), 4), NULL, NULL FROM buckets GROUP BY bucket"""
    for c in ("l_quantity", "l_discount")
) + """
UNION ALL SELECT 'l_returnflag', 'categorical', concat('target_mean[', l_returnflag, ']'), round(avg(l_extendedprice), 4), NULL, NULL
FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'absent', 'not_found', 'not_found', NULL, NULL, NULL
UNION ALL SELECT 'same', 'constant', 'constant', NULL, NULL, NULL"""
ORACLE["evidence_table"] = with_(_BUCKETS) + f"""
SELECT * REPLACE (CAST(significant AS VARCHAR) AS significant) FROM ({_EVIDENCE_ROWS})"""


def _class_evidence(features: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT feature, 'categorical' AS kind, 'chi2' AS statistic, chi2 AS value, p_value, significant
FROM ({_chi2_test("labelled_documents", c, "quality", 15)})
UNION ALL SELECT '{c}', 'categorical', concat('rate[1|', {c}, ']'), count(*) FILTER (quality = 1) / count(*), NULL, NULL
FROM labelled_documents GROUP BY {c} HAVING count(*) FILTER (quality = 1) > 0"""
        for c in features
    )


ORACLE["evidence_classes"] = cte("labelled_documents") + f""",
found AS (
{_class_evidence(["lang", "toxic"])}
UNION ALL SELECT 'n_chars', 'numeric', 'correlation', corr(n_chars, quality), NULL, NULL FROM labelled_documents
UNION ALL SELECT feature, 'numeric', 'welch_t', t, p_value, significant
FROM ({_welch("labelled_documents", "n_chars", "quality", "n_chars", 15)})
UNION ALL SELECT 'n_chars', 'numeric', concat('mean[', quality, ']'), avg(n_chars), NULL, NULL FROM labelled_documents GROUP BY quality)
SELECT feature, kind, statistic, round(value, 4) AS value, round(p_value, 4) AS p_value,
  CAST(significant AS VARCHAR) AS significant FROM found"""
ORACLE["evidence_text"] = cte("labelled_documents") + f""",
found AS (
{_class_evidence(["lang", "toxic"])})
SELECT feature, concat(statistic, ': ', printf('%.2f', value)) AS observation,
  CASE WHEN p_value IS NULL THEN 'N/A' ELSE concat(CASE WHEN significant THEN 'SIGNIFICANT' ELSE 'NOT SIGNIFICANT' END, ' (',
    CASE WHEN p_value < 0.001 THEN 'p < 0.001' ELSE printf('p=%.4f', p_value) END, ')') END AS significance FROM found"""

# --- screening -----------------------------------------------------------

ORACLE["id_columns"] = "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM orders HAVING count(DISTINCT {c}) >= 0.95 * count(*)"
    for c, t in ORDERS.items() if t != "double"
) + ")"
ORACLE["low_variance"] = cte("wide_lineitem") + each(
    ["l_linenumber", "l_quantity", "l_discount", "l_tax", "zero_col"],
    """
SELECT '{c}' AS "column", round(var_pop({c}), 4) AS variance, var_pop({c}) > 0 AS kept FROM wide_lineitem""",
)
ORACLE["high_corr_drop"] = cte("wide_lineitem") + "\nSELECT DISTINCT \"column\" FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{b}' AS \"column\", {_r(a, b)} AS r FROM wide_lineitem" for a, b in _pairs(numbers(WIDE_LINEITEM))
) + "\n) WHERE abs(r) > 0.9"
ORACLE["leak_features"] = cte("wide_lineitem") + "\nSELECT \"column\" FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", {_r(c, 'l_quantity')} AS r FROM wide_lineitem"
    for c in numbers(WIDE_LINEITEM) if c != "l_quantity"
) + "\n) WHERE abs(r) >= 0.95"


def _screened(table: str, names: list[str], target: str, ids: list[str]) -> str:
    """(feature, status, reason) by the screening order: ids, variance, correlation, leakage."""
    wide = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in names)
    base = f"SELECT {wide}, {target} AS target_ FROM {table}"
    pairs = "\nUNION ALL\n".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, abs({_r(f'"{a}"', f'"{b}"')}) AS r FROM base""" for a, b in _pairs(names)
    )
    var = "\nUNION ALL\n".join(f"""SELECT '{c}' AS c, min("{c}") = max("{c}") AS flat, abs({_r(f'"{c}"', "target_")}) AS ry FROM base""" for c in names)
    out = f"""base AS ({base}), pairs AS ({pairs}), facts AS ({var}),
judged AS (SELECT c, CASE WHEN flat THEN 'low_variance'
  WHEN EXISTS (SELECT 1 FROM pairs JOIN facts e ON e.c = pairs.a WHERE pairs.b = facts.c AND NOT e.flat AND pairs.r > 0.9) THEN 'high_correlation'
  WHEN ry >= 0.95 THEN 'leakage' END AS reason FROM facts)
SELECT c AS feature, CASE WHEN reason IS NULL THEN 'used' ELSE 'dropped' END AS status, reason FROM judged"""
    return out + "".join(f"\nUNION ALL SELECT '{c}', 'dropped', 'id'" for c in ids)


ORACLE["feature_selection"] = cte("wide_lineitem") + ",\n" + _screened(
    "wide_lineitem", [c for c in WIDE_LINEITEM if c != "target"], "target", []
)
_PRIORITIES = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_FLAT_ORDERS = """flat_orders AS (SELECT o_custkey, o_totalprice, epoch(o_orderdate) AS o_orderdate,
  o_orderstatus = 'O' AS "o_orderstatus_O", o_orderstatus = 'P' AS "o_orderstatus_P",
  """ + ", ".join(f"o_orderpriority = '{v}' AS \"o_orderpriority_{v}\"" for v in _PRIORITIES) + """,
  CAST(o_orderstatus = 'O' AS INT) AS late FROM orders)"""
ORACLE["feature_selection_mixed"] = with_(_FLAT_ORDERS) + ",\n" + _screened(
    "flat_orders",
    ["o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus_O", "o_orderstatus_P",
     *[f"o_orderpriority_{v}" for v in _PRIORITIES]],
    "late", ["o_orderkey"],
)

# --- models --------------------------------------------------------------

_SPLIT = """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5(concat('42:', CAST(o_orderkey AS VARCHAR))))
  <= ceil(0.2 * (SELECT count(*) FROM orders)) THEN 'test' ELSE 'train' END AS split FROM orders"""
ORACLE["train_test_rows"] = _SPLIT
ORACLE["train_test_split"] = f"SELECT split, count(*) AS cnt FROM ({_SPLIT}) GROUP BY split"


def _clf(table: str, y: str, yhat: str) -> str:
    """CTEs up to ``m``: one row of metrics."""
    return f"""classes AS (SELECT c, (SELECT count(*) FROM {table} WHERE {y} = c) AS actual, (SELECT count(*) FROM {table} WHERE {yhat} = c) AS said,
  (SELECT count(*) FROM {table} WHERE {y} = c AND {yhat} = c) AS hit
  FROM (SELECT {y} AS c FROM {table} UNION SELECT {yhat} FROM {table})),
scored AS (SELECT *, CASE WHEN said = 0 THEN 0 ELSE hit / said END AS p, CASE WHEN actual = 0 THEN 0 ELSE hit / actual END AS r FROM classes),
m AS (SELECT sum(hit) / sum(actual) AS accuracy, sum(actual * p) / sum(actual) AS precision, sum(actual * r) / sum(actual) AS recall,
  sum(actual * CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) / sum(actual) AS f1_weighted,
  CASE WHEN count(*) FILTER (actual > 0) = 2 THEN avg(r) FILTER (actual > 0) END AS roc_auc FROM scored)"""


_METRICS = ["accuracy", "precision", "recall", "f1_weighted", "roc_auc"]
_METRIC_ROWS = "SELECT * FROM (" + each(_METRICS, "SELECT '{c}' AS metric, round({c}, 6) AS value FROM m") + ") WHERE value IS NOT NULL"
ORACLE["clf_metrics"] = with_(_clf("labels", "quality", "toxic")) + "\n" + _METRIC_ROWS
ORACLE["clf_metrics_multi"] = with_(
    "guesses AS (SELECT l_linenumber AS y, (l_linenumber + l_orderkey) % 5 AS yhat FROM lineitem)", _clf("guesses", "y", "yhat")
) + "\n" + _METRIC_ROWS
ORACLE["model_strength"] = with_(_clf("labels", "quality", "toxic")) + "\n" + each(
    _METRICS,
    """SELECT '{c}' AS metric, round({c}, 2) AS value, CASE WHEN roc_auc > 0.85 THEN 'Strong' WHEN roc_auc > 0.75 THEN 'Good'
  WHEN roc_auc < 0.6 THEN 'Weak' ELSE 'Moderate' END AS strength FROM m""",
)
ORACLE["sanity_check"] = with_(_clf("labels", "quality", "toxic")) + """
SELECT 'accuracy' AS "check", accuracy >= 0.55 AS passed, round(accuracy, 6) AS detail FROM m"""
ORACLE["model_select"] = """WITH t AS (SELECT quality AS y, 1 AS base, 1 - toxic AS flag FROM labels),
f AS (SELECT model, sum(actual * CASE WHEN said + actual = 0 THEN 0 ELSE 2.0 * hit / (said + actual) END) / sum(actual) AS score FROM (
  SELECT model, c, count(*) FILTER (y = c) AS actual, count(*) FILTER (yhat = c) AS said, count(*) FILTER (y = c AND yhat = c) AS hit
  FROM (SELECT 'Baseline Model' AS model, y, base AS yhat FROM t UNION ALL SELECT 'Flag Model', y, flag FROM t)
  CROSS JOIN (SELECT unnest([0, 1]) AS c) GROUP BY model, c) GROUP BY model)
SELECT model, round(score, 6) AS score FROM f ORDER BY f.score DESC, model LIMIT 1"""
ORACLE["reg_metrics"] = cte("forecast_lineitem") + """
SELECT 'rmse' AS metric, round(sqrt(avg(pow(actual - forecast, 2))), 4) AS value FROM forecast_lineitem
UNION ALL SELECT 'r2', round(1 - sum(pow(actual - forecast, 2)) / (count(*) * var_pop(actual)), 4) FROM forecast_lineitem"""
ORACLE["balanced_weights"] = """SELECT o_orderstatus AS class,
  round((SELECT count(*) / count(DISTINCT o_orderstatus) FROM orders) / count(*), 6) AS weight FROM orders GROUP BY o_orderstatus"""
ORACLE["linear_baseline"] = """SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem"""

# --- charts --------------------------------------------------------------


def _hist(table: str, c: str, bins: int = 20) -> str:
    return f"""SELECT '{c}' AS "column", bin, round(lo + bin * w, 4) AS lower, round(lo + (bin + 1) * w, 4) AS upper, count(*) AS cnt
FROM (SELECT lo, (hi - lo) / {bins} AS w, least({bins - 1}, CAST(floor((x - lo) / ((hi - lo) / {bins})) AS BIGINT)) AS bin
  FROM (SELECT CAST({c} AS DOUBLE) AS x, CAST(min({c}) OVER () AS DOUBLE) AS lo, CAST(max({c}) OVER () AS DOUBLE) AS hi
    FROM {table} WHERE {c} IS NOT NULL))
GROUP BY bin, lo, w"""


ORACLE["chart_histogram"] = _hist("lineitem", "l_quantity") + "\nUNION ALL\n" + _hist("lineitem", "l_extendedprice")


def _box(table: str, c: str) -> str:
    return f"""SELECT '{c}' AS "column", round(any_value(q[1]), 4) AS q1, round(any_value(q[2]), 4) AS median, round(any_value(q[3]), 4) AS q3,
  round(min(x) FILTER (x >= lo AND x <= hi), 4) AS low_whisker, round(max(x) FILTER (x >= lo AND x <= hi), 4) AS high_whisker,
  count(*) FILTER (x < lo OR x > hi) AS outliers
FROM (SELECT CAST({c} AS DOUBLE) AS x, q, q[1] - 1.5 * (q[3] - q[1]) AS lo, q[3] + 1.5 * (q[3] - q[1]) AS hi
  FROM {table}, (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM {table}))"""


ORACLE["chart_box"] = _box("documents", "n_chars")
ORACLE["chart_bar"] = _top("part", ["p_brand", "p_type"], None, False)
ORACLE["chart_scatter_grid"] = f"""SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, {_width_bin("l_quantity", 20)} AS bx,
  {_width_bin("l_extendedprice", 20)} AS "by", count(*) AS cnt FROM lineitem GROUP BY 3, 4"""
ORACLE["chart_line_day"] = """SELECT 'ts' AS x, 'value' AS y, CAST(date_trunc('day', ts) AS TIMESTAMP) AS "at", round(avg(value), 4) AS mean,
  round(min(value), 4) AS low, round(max(value), 4) AS high, count(value) AS cnt FROM events GROUP BY 3"""


def _chart_batch() -> str:
    nums, cats = numbers(ORDERS), ["o_orderstatus", "o_orderpriority"]
    parts, no = [], 0

    def add(kind: str, x: str, y: str, body: str) -> None:
        nonlocal no
        parts.append(f"SELECT {no} AS chart_no, '{kind}' AS kind, '{x}' AS x, {y} AS y, CAST(bin AS VARCHAR) AS bin, round(CAST(value AS DOUBLE), 7) AS value FROM ({body})")
        no += 1

    for c in nums:
        add("histogram", c, "NULL", f"SELECT bin, cnt AS value FROM ({_hist('orders', c)})")
        marks = each(
            ["q1", "median", "q3", "low_whisker", "high_whisker", "outliers"], "SELECT '{c}' AS bin, {c} AS value FROM bx"
        )
        add("box", c, "NULL", f"WITH bx AS ({_box('orders', c)}) {marks}")
    for c in cats:
        add("bar", c, "NULL", f"SELECT {c} AS bin, count(*) AS value FROM orders GROUP BY {c}")
    for a, b in _pairs(nums):
        add("scatter", a, f"'{b}'", f"SELECT concat({_width_bin(a, 20, 'orders')}, ',', {_width_bin(b, 20, 'orders')}) AS bin, count(*) AS value FROM orders GROUP BY 1")
    for c in nums:
        add("line", "o_orderdate", f"'{c}'", f"SELECT strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS bin, avg({c}) AS value FROM orders GROUP BY 1")
    return "\nUNION ALL\n".join(parts)


ORACLE["chart_batch"] = _chart_batch()

# --- run log, pipelines --------------------------------------------------

ORACLE["run_log_latest"] = cte("event_runs") + """
SELECT run_id, status FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ended_at DESC, event_id DESC) AS rn FROM event_runs)
WHERE rn = 1"""
ORACLE["profile_pipeline"] = "\nUNION ALL\n".join(
    [f"SELECT 'n_unique' AS section, '{c}' AS item, CAST(count(DISTINCT {c}) AS DOUBLE) AS value FROM orders" for c in ORDERS]
    + [f"SELECT 'pearson', '{a}__{b}', {_r(a, b)} FROM orders" for a in numbers(ORDERS) for b in numbers(ORDERS)]
    + [f"SELECT 'cramers_v', concat(col_a, '__', col_b), v FROM ({ORACLE['cramers_v']})",
       f"SELECT 'anova', feature, p_value FROM ({ORACLE['anova']})"]
)

# --- order of rows, delimited files ---------------------------------------

_NUMBERED = "(SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders)"
ORACLE["keep_first_in_file"] = f"SELECT * FROM {_NUMBERED} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY position) = 1"
ORACLE["first_seen_codes"] = f"""SELECT o_orderpriority AS value, row_number() OVER (ORDER BY min(position)) - 1 AS code
FROM {_NUMBERED} WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority"""
_MARKS = ", ".join(f"'{m}'" for m in MISSING_MARKS)
ORACLE["csv_quoted_breaks"] = "SELECT doc_id, " + ", ".join(
    f"CASE WHEN {c} NOT IN ({_MARKS}) THEN {c} END AS {c}" for c in ("text", "lang", "source")
) + " FROM documents"

# --- scoring --------------------------------------------------------------

_MINORS = {
    "bq": "qy * (dd * tt - dt * dt) - qd * (dy * tt - dt * ty) + qt * (dy * dt - dd * ty)",
    "bd": "qq * (dy * tt - dt * ty) - qy * (qd * tt - dt * qt) + qt * (qd * ty - dy * qt)",
    "bt": "qq * (dd * ty - dy * dt) - qd * (qd * ty - dy * qt) + qy * (qd * dt - dd * qt)",
}
_SHORT = {"q": "l_quantity", "d": "l_discount", "t": "l_tax", "y": "l_extendedprice"}
_COVARIANCES = ", ".join(f"covar_pop({_SHORT[a]}, {_SHORT[b]}) AS {a}{b}" for a, b in ("qq", "qd", "qt", "dd", "dt", "tt", "qy", "dy", "ty"))
ORACLE["score_batch"] = f"""WITH m AS (SELECT {', '.join(f"avg({c}) AS {a}" for a, c in _SHORT.items())}, {_COVARIANCES} FROM lineitem),
b AS (SELECT *, {', '.join(f"({sql}) / det AS {n}" for n, sql in _MINORS.items())}
  FROM (SELECT *, qq * (dd * tt - dt * dt) - qd * (qd * tt - dt * qt) + qt * (qd * dt - dd * qt) AS det FROM m))
SELECT l_orderkey, l_linenumber, round(y + bq * (l_quantity - q) + bd * (l_discount - d) + bt * (l_tax - t), 2) AS prediction FROM lineitem, b"""
