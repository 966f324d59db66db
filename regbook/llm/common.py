"""What the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handed to a Python worker at once; long documents then make short batches.
BATCH_BYTES = 16 << 20
SPACES = " \t\n\x0b\x0c\r"


def _tidy(
    batches: Iterator[pa.RecordBatch], function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """``function``, and at its end the memory it has freed goes back to the machine:
    a worker that waits for its next task keeps all it ever had otherwise."""
    yield from function(batches)
    release()


def release() -> None:
    """Give freed memory back."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_map(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes as well as in rows."""
    spark = df.sparkSession
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(partial(_tidy, function=function), schema)


def quoted(name: str) -> Column:
    """A column by its name as it is, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_null(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())


def row_key(*columns: str) -> list[Column]:
    """Two 64-bit hashes of a row's content, nulls told apart from empty strings.
    Rows that repeat share them; they stay the same when a lost task is run again."""
    marked = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *marked)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
