"""Delimited text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.parsing import parse_decimal, parse_short_date
from ..schema import DATE_COLUMN, DECIMAL_COLUMNS, REGISTRY_SCHEMA


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    sep: str = ";",
    header: bool = True,
) -> DataFrame:
    """Scan delimited text. Without ``schema`` the types are inferred, which costs an
    extra pass over the files; records never span lines, so large files stay splittable."""
    reader = spark.read.option("sep", sep).option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def load_registry(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The registry file with its date and decimal columns parsed."""
    raw = read_delimited(spark, path, REGISTRY_SCHEMA)
    return raw.transform(parse_short_date, DATE_COLUMN).transform(parse_decimal, DECIMAL_COLUMNS)
