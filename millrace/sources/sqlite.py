"""SQLite tables as a Spark data source: ranges of rowids, columns and filters pushed down.

The file must lie where all executors see it.  A table is read in ranges of its rowid;
a table without rowids, a view or a query is read in one partition, as SQLite gives no
way to tell its parts.  Columns take the type of the values they hold (SQLite types
values, not columns): whole numbers, else numbers, bytes only, else text.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    IsNull, LessThan, LessThanOrEqual,
)

from millrace.functions.types import nan_to_null
from millrace.session import ship_package

FORMAT = "millrace_sqlite"
BATCH_ROWS = 10_000
PARTS = 8
_COMPARISONS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def _source(options: dict[str, str]) -> str:
    return _name(options["table"]) if options.get("table") else f"({options['query']})"


def _types(path: str, source: str) -> T.StructType:
    """One scan by SQLite: which kinds of values each column holds."""
    con = _connect(path)
    try:
        names = [c[0] for c in con.execute(f"SELECT * FROM {source} LIMIT 0").description]
        kinds = ("text", "blob", "real", "integer")
        tests = ", ".join(f"max(typeof({_name(n)}) = '{k}')" for n in names for k in kinds)
        found = con.execute(f"SELECT {tests} FROM {source}").fetchone()
    finally:
        con.close()
    schema = T.StructType()
    for i, n in enumerate(names):
        text, blob, real, whole = found[4 * i : 4 * i + 4]
        kind = T.BinaryType() if blob and not (text or real or whole) else T.StringType()
        if not text and not blob and (real or whole):
            kind = T.DoubleType() if real else T.LongType()
        schema.add(n, kind)
    return schema


class RowidRange(InputPartition):
    """Rows with low <= rowid <= high; the whole source without bounds."""

    def __init__(self, low: int | None, high: int | None):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.options = schema, options
        self.tests: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Keep what SQLite decides as Spark does; give back the rest."""
        for f in filters:
            if not self._taken(f):
                yield f

    def _taken(self, f: Filter) -> bool:
        path = getattr(f, "attribute", ())
        if len(path) != 1:
            return False
        kind = self.schema[path[0]].dataType
        if isinstance(f, (IsNull, IsNotNull)):
            self.tests.append(f"{_name(path[0])} IS {'' if isinstance(f, IsNull) else 'NOT '}NULL")
            return True
        values = list(f.value) if isinstance(f, In) else [getattr(f, "value", None)]
        fits = (int, float) if isinstance(kind, (T.LongType, T.DoubleType)) else str
        # Texts are compared for equality only: a column may hold numbers as well.
        if not values or not all(isinstance(v, fits) and not isinstance(v, bool) for v in values):
            return False
        column = _name(path[0]) if fits is not str else f"cast({_name(path[0])} AS TEXT)"
        if isinstance(f, In):
            self.tests.append(f"{column} IN ({', '.join('?' * len(values))})")
        elif type(f) in _COMPARISONS and (fits is not str or isinstance(f, EqualTo)):
            self.tests.append(f"{column} {_COMPARISONS[type(f)]} ?")
        else:
            return False
        self.values += values
        return True

    def partitions(self) -> Sequence[InputPartition]:
        parts = int(self.options.get("parts", PARTS))
        if not self.options.get("table") or parts < 2:
            return [RowidRange(None, None)]
        con = _connect(self.options["path"])
        try:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_source(self.options)}").fetchone()
        except sqlite3.OperationalError:
            return [RowidRange(None, None)]
        finally:
            con.close()
        if not isinstance(low, int):
            return [RowidRange(None, None)]
        step = max(1, -(-(high - low + 1) // parts))
        return [RowidRange(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, partition: RowidRange) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        tests, values = list(self.tests), list(self.values)
        if partition.low is not None:
            tests.append("rowid BETWEEN ? AND ?")
            values += [partition.low, partition.high]
        columns = ", ".join(_as(f) for f in self.schema)
        where = f" WHERE {' AND '.join(tests)}" if tests else ""
        con = _connect(self.options["path"])
        try:
            rows = con.execute(f"SELECT {columns} FROM {_source(self.options)}{where}", values)
            while some := rows.fetchmany(BATCH_ROWS):
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        finally:
            con.close()


def _as(field: T.StructField) -> str:
    name = _name(field.name)
    return f"cast({name} AS TEXT)" if isinstance(field.dataType, T.StringType) else name


class SqliteSource(DataSource):
    """Options: ``path``; ``table`` or ``query``; ``parts``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return _types(self.options["path"], _source(self.options))

    def reader(self, schema: T.StructType) -> SqliteReader:
        return SqliteReader(schema, dict(self.options))


def load_sqlite(spark: SparkSession, path: str, what: str, parts: int = PARTS) -> DataFrame:
    """A table by its name, or the rows of a query."""
    ship_package(spark)
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    kind = "query" if what.strip().lower().startswith(("select ", "with ", "values")) else "table"
    return nan_to_null(spark.read.format(FORMAT).options(path=path, parts=str(parts), **{kind: what.strip().rstrip(";")}).load())
