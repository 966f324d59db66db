"""Lookup tables that live in code.

They are built as SQL ``VALUES``, so Catalyst knows their exact size and broadcasts
them on its own; no hint is needed and nothing unmeasured is ever broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schema import OPERATIONS, REGIONS


def lookup(spark: SparkSession, rows: Sequence[Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """A text lookup table from literal rows."""
    cells = {f"r{i}_{j}": v for i, row in enumerate(rows) for j, v in enumerate(row)}
    # Named, because positional markers inside VALUES are not bound in reading order.
    markers = [f"({', '.join(f':r{i}_{j}' for j in range(len(row)))})" for i, row in enumerate(rows)]
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT * FROM VALUES {', '.join(markers)} AS t({names})", args=cells)


def region_dim(spark: SparkSession) -> DataFrame:
    return lookup(spark, REGIONS, ("REG_ADDR_KOATUU", "REGION_NAME"))


def operation_dim(spark: SparkSession) -> DataFrame:
    return lookup(spark, OPERATIONS, ("OPER_CODE", "OPER_DESC"))
