"""Type tests on Spark schemas.

``number`` excludes booleans; the looser ``number_like`` test lets a boolean
take part as 0/1.  NaN counts as missing everywhere, so loaders map it to NULL
once and the operators only ever test for NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)


class NestedColumnError(ValueError):
    """Raised when a table holds array, map, struct or binary columns."""


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_boolean(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.BooleanType)


def is_number_like(dtype: T.DataType) -> bool:
    return is_number(dtype) or is_boolean(dtype)


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def _matching(df: DataFrame, test) -> list[str]:
    return [f.name for f in df.schema.fields if test(f.dataType)]


def number_columns(df: DataFrame) -> list[str]:
    return _matching(df, is_number)


def number_like_columns(df: DataFrame) -> list[str]:
    return _matching(df, is_number_like)


def float_columns(df: DataFrame) -> list[str]:
    return _matching(df, is_float)


def text_columns(df: DataFrame) -> list[str]:
    return _matching(df, is_text)


def time_columns(df: DataFrame) -> list[str]:
    return _matching(df, is_time)


def boolean_columns(df: DataFrame) -> list[str]:
    return _matching(df, is_boolean)


def dtype_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def require_column(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found; have {df.columns}")


def require_flat(df: DataFrame) -> None:
    """Reject nested columns: the data model is a flat table."""
    nested = _matching(df, lambda t: isinstance(t, _NESTED))
    if nested:
        raise NestedColumnError(f"nested columns are not supported: {nested}")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Map NaN to NULL in float columns."""
    floats = float_columns(df)
    if not floats:
        return df
    return df.withColumns(
        {c: F.nanvl(ref(c), F.lit(None).cast(dtype_of(df, c))) for c in floats}
    )


def ref(name: str) -> Column:
    """A column reference that survives dots and spaces in names."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_number(df: DataFrame, name: str) -> Column:
    """The column as double; booleans become 0/1."""
    c = ref(name)
    if is_boolean(dtype_of(df, name)):
        c = c.cast("int")
    return c.cast("double")


def free_name(df: DataFrame, wish: str) -> str:
    """The wished name, or one like it that the table doesn't have."""
    while wish.lower() in {c.lower() for c in df.columns}:
        wish += "_"
    return wish
