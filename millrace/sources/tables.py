"""Table readers.  Missing-value marks and NaN become NULL here, once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import chunks
from millrace.functions.types import nan_to_null, ref
from millrace.operators.cleaning import NUMBER_SHAPE
from millrace.sources.delimited import has_broken_records, read_delimited
from millrace.sources.payload import holds_array, read_array
from millrace.sources.roworder import number_rows
from millrace.sources.sqlite import PARTS, load_sqlite

# Text read as missing in delimited files.
MISSING_MARKS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
WHOLE_SHAPE = r"^\s*[+-]?\d{1,18}\s*$"
SQLITE = "sqlite:///"
KINDS = ("csv", "json", "parquet", "api", "database", "jdbc")


def load_csv(spark: SparkSession, path: str, schema: str | None = None, position: str | None = None) -> DataFrame:
    """A file with a header row.

    With a schema the file is read once.  Without one, all columns are read as
    text and typed in one counting pass: whole numbers, numbers, booleans,
    else text.  Dates stay text, for the type correction step to judge.
    Two quotes within a quoted field are one.  Files with line breaks in
    quoted fields are cut into records first, range by range.  ``position``
    names a column for the row's number in the files; records cut that way
    have none.
    """
    if has_broken_records(spark, path):
        if position is not None:
            raise ValueError("rows can't be numbered in files with line breaks in quoted fields")
        raw = read_delimited(spark, path, schema)
    else:
        reader = spark.read.option("header", True).option("multiLine", False).option("escape", '"')
        if schema is not None:
            reader = reader.schema(schema).option("nullValue", "")
        raw = reader.csv(path) if position is None else number_rows(reader.csv(path), position)
    if schema is not None:
        return nan_to_null(raw)
    texts = [c for c in raw.columns if c != position]
    return infer_text_types(raw.withColumns({c: F.when(~ref(c).isin(*MISSING_MARKS), ref(c)) for c in texts}), texts)


def infer_text_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast text columns (all, if none are named) whose every present value fits a tighter type."""
    casts: dict[str, Column] = {}
    for block in chunks(df.columns if columns is None else columns, 50):
        row = df.agg(
            *[
                F.struct(
                    F.count(ref(c)).alias("n"),
                    F.count_if(ref(c).rlike(WHOLE_SHAPE)).alias("whole"),
                    F.count_if(ref(c).rlike(NUMBER_SHAPE)).alias("number"),
                    F.count_if(ref(c).isin("True", "False", "TRUE", "FALSE", "true", "false")).alias("truth"),
                ).alias(f"s{i}")
                for i, c in enumerate(block)
            ]
        ).first()
        for c, s in zip(block, row):
            if s["n"] == 0 or s["number"] == s["n"]:
                kind = "bigint" if s["n"] and s["whole"] == s["n"] else "double"
                casts[c] = F.trim(ref(c)).try_cast(kind)
            elif s["truth"] == s["n"]:
                casts[c] = ref(c).try_cast("boolean")
    return df.withColumns(casts) if casts else df


def load_parquet(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """``position`` names a column for the row's number in the files."""
    raw = spark.read.parquet(path)
    return nan_to_null(raw if position is None else number_rows(raw, position))


def load_payload(spark: SparkSession, path: str) -> DataFrame:
    """Landed service responses: JSON records, else delimited text.

    An array of objects is cut into its objects range by range; any other
    document is read whole.  A JSON document that cannot be read leaves only
    the corrupt-record column.
    """
    try:
        found = read_array(spark, path) if holds_array(spark, path) else spark.read.option("multiLine", True).json(path)
        names = found.columns
    except Exception as e:  # a file Spark's JSON reader rejects outright
        if "UNABLE_TO_INFER_SCHEMA" not in str(e) and "MALFORMED" not in str(e):
            raise
        names = []
    if not names or names == ["_corrupt_record"]:
        return load_csv(spark, path)
    return nan_to_null(found)


def jdbc_options(
    url: str, query: str, partition: Mapping[str, object] | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    """Reader options for a query run by the database.

    A parallel read needs column, lower, upper and parts; Spark then takes the
    query as a derived table.
    """
    if not url.startswith("jdbc:"):
        raise ValueError("a JDBC url starts with 'jdbc:'")
    options = {"url": url, "fetchsize": str(fetch_size)}
    if partition is None:
        return {**options, "query": query}
    return {
        **options,
        "dbtable": f"({query}) AS source",
        "partitionColumn": str(partition["column"]),
        "lowerBound": str(partition["lower"]),
        "upperBound": str(partition["upper"]),
        "numPartitions": str(partition["parts"]),
    }


def load_database(
    spark: SparkSession, url: str, query: str, partition: Mapping[str, object] | None = None
) -> DataFrame:
    """SQLite files need nothing else; other databases need their driver jar on the cluster's class path."""
    if url.startswith(SQLITE):
        return load_sqlite(spark, url.removeprefix(SQLITE), query, int((partition or {}).get("parts", PARTS)))
    return nan_to_null(spark.read.format("jdbc").options(**jdbc_options(url, query, partition)).load())


def load_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Dispatch by kind; a database path is ``url|query``, for SQLite ``sqlite:///file|table`` or ``|query``."""
    if kind == "csv":
        return load_csv(spark, path)
    if kind in ("json", "api"):
        return load_payload(spark, path)
    if kind == "parquet":
        return load_parquet(spark, path)
    if kind in ("database", "jdbc"):
        url, query = path.split("|", 1)
        return load_database(spark, url, query)
    raise ValueError(f"unsupported source kind {kind!r}; use one of {KINDS}")


def preview(df: DataFrame, order_by: list[str], rows: int = 5) -> DataFrame:
    """The first rows in the given order (a top-k, not a full sort)."""
    return df.orderBy(*[ref(c) for c in order_by]).limit(rows)


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)
