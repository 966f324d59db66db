"""Interquartile-range outlier filter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted
from .quantiles import approx_quantiles, exact_quantiles, sketch_columns


@dataclass(frozen=True)
class IqrBound:
    """Inclusive limits of one column."""

    column: str
    lower: float | Decimal
    upper: float | Decimal

    def keeps(self) -> Column:
        """NULL or within the limits. The limits are literals, so a Parquet scan below
        can skip row groups with them."""
        column = F.col(quoted(self.column))
        return column.isNull() | column.between(self.lower, self.upper)


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 3.0,
    floor: float | None = 0.0,
    method: str = "exact",
) -> list[IqrBound]:
    """Limits ``[q1 - k*iqr, q3 + k*iqr]`` per column, never below ``floor``.

    Columns are taken in order and each one's quartiles come from the rows that the
    earlier limits keep. A column that is absent, empty or has no spread sets no limit.
    One pass sketches all columns; after it each column takes one more while the values
    near its quartiles fit in a task.
    """
    present = [c for c in columns if c in df.columns]
    sketched = sketch_columns(df, present) if method == "exact" and present else None
    bounds: list[IqrBound] = []
    for column in present:
        wanted = {column: (0.25, 0.75)}
        if method == "exact":
            q1, q3 = exact_quantiles(df, wanted, sketched=sketched)[column]
        else:
            q1, q3 = approx_quantiles(df, wanted)[column]
        if q1 is None or not q3 - q1 > 0:
            continue
        reach = _times(k, q3 - q1)
        lower, upper = q1 - reach, q3 + reach
        bound = IqrBound(column, lower if floor is None else max(type(lower)(floor), lower), upper)
        bounds.append(bound)
        df = df.filter(bound.keeps())
    return bounds


def _times(k: float, spread):
    return Decimal(repr(k)) * spread if isinstance(spread, Decimal) else k * spread


def within_bounds(df: DataFrame, bounds: Sequence[IqrBound]) -> DataFrame:
    for bound in bounds:
        df = df.filter(bound.keeps())
    return df


def iqr_filter(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 3.0,
    floor: float | None = 0.0,
    method: str = "exact",
) -> DataFrame:
    return within_bounds(df, iqr_bounds(df, columns, k, floor, method))
