"""Folding rare labels into one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..schema import OTHER
from .groups import GroupTable, group_table

_COUNT = "__label_count"


def label_counts(df: DataFrame, column: str) -> GroupTable:
    return group_table(df, [column], {_COUNT: F.count(F.lit(1))})


def fold_labels(
    df: DataFrame,
    column: str,
    counts: GroupTable,
    min_count: int = 10,
    other: str = OTHER,
    limit: int | None = None,
) -> DataFrame:
    """Replace labels counted fewer than ``min_count`` times. NULL is not a label."""
    return fold_counted(counts.attach(df, limit), column, min_count, other)


def is_rare(column: str, min_count: int) -> Column:
    """Whether the label of a row with its count attached is to be folded."""
    return F.col(quoted(column)).isNotNull() & (F.col(_COUNT) < min_count)


def fold_counted(counted: DataFrame, column: str, min_count: int, other: str) -> DataFrame:
    """Fold the labels of rows that have their counts attached."""
    label = F.when(is_rare(column, min_count), other).otherwise(F.col(quoted(column)))
    return counted.withColumn(column, label).drop(_COUNT)


def rare_labels(counts: GroupTable, min_count: int) -> int:
    """How many labels are folded, from the table of counts alone."""
    (key,) = counts.key_columns
    return counts.table.filter(F.col(key).isNotNull() & (F.col(_COUNT) < min_count)).count()


def fold_rare(
    df: DataFrame,
    column: str,
    min_count: int = 10,
    other: str = OTHER,
    limit: int | None = None,
) -> DataFrame:
    """Labels with fewer than ``min_count`` rows become ``other``."""
    return fold_labels(df, column, label_counts(df, column), min_count, other, limit)
