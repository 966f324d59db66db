"""Choosing columns by type, and what "missing" means for each type."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def quoted(name: str) -> str:
    """A column name as it is, dots and backticks included."""
    return f"`{name.replace('`', '``')}`"


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _may_be_nan(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DoubleType, FloatType))


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type has one."""
    column = F.col(quoted(name))
    return column.isNull() | F.isnan(column) if _may_be_nan(df, name) else column.isNull()


def number_type(df: DataFrame, name: str) -> str:
    """The widest type without loss: ``bigint``, ``decimal(p,s)`` or ``double``."""
    kind = df.schema[name].dataType
    if isinstance(kind, _WHOLE):
        return "bigint"
    return kind.simpleString() if isinstance(kind, DecimalType) else "double"


def own_numbers(df: DataFrame, columns: Iterable[str], prefix: str = "v") -> DataFrame:
    """Only these columns, in order and named ``v0``, ``v1``, ..., each in its
    ``number_type``, with NaN turned into NULL.

    A projection of its own on purpose: aggregates that use a column many times then
    refer to a computed value, and their generated code stays small enough to compile.
    Names by position, since a column's own name may hold anything.
    """

    def number(name: str) -> Column:
        column = F.col(quoted(name)).cast(number_type(df, name))
        return F.nullif(column, F.lit(math.nan)) if _may_be_nan(df, name) else column

    return df.select(*[number(c).alias(f"{prefix}{i}") for i, c in enumerate(columns)])


def as_numbers(df: DataFrame, columns: Iterable[str], prefix: str = "v") -> DataFrame:
    """``own_numbers`` as double."""
    numbers = own_numbers(df, columns, prefix)
    return numbers.select(*[F.col(c).cast("double").alias(c) for c in numbers.columns])
