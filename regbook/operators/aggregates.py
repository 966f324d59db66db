"""Grouped aggregates. Each combines on the map side before its one shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, keys: Sequence[str], value, name: str, digits: int) -> DataFrame:
    """Mean per group, rounded half up."""
    return df.groupBy(*keys).agg(F.round(F.avg(value), digits).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], value, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def distinct_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact number of distinct values. Spark aggregates on (keys, value) first, so a
    heavy key is spread over many tasks."""
    return df.groupBy(*keys).agg(F.count_distinct(F.col(value)).alias(name))
