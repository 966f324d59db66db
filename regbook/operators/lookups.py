"""Joining rows to a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_lookup(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key``; rows without an entry drop out. Lookups defined in code or
    read from files have a known size, so Catalyst broadcasts them while they are under
    the session's limit and shuffles (with adaptive skew splitting) when they are not."""
    return df.join(dim, key, "inner")
