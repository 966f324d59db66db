"""Table profiles, returned as DataFrames.

Each profile is one aggregate over the columns it needs, however many columns there
are; the single result row is then unfolded into a long table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_numbers, is_missing, numeric_columns, quoted, text_columns
from ..storage import materialise
from .quantiles import approx_quantiles, exact_quantiles

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def _unfold(row: DataFrame, records: Sequence[Column]) -> DataFrame:
    """One output row per struct; all structs have the same fields."""
    return row.select(F.inline(F.array(*records)))


def profile_shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def profile_schema(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of every column. Reads no data."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, nullable boolean"
    )


def profile_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values (NULL or NaN) per column."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(columns)])
    return _unfold(
        counts,
        [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_missing")) for i, c in enumerate(columns)],
    )


def profile_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact"
) -> DataFrame:
    """count, mean, stddev, min, quartiles and max per numeric column, as a long table of
    (column, metric, value). NaN counts as missing. ``method`` chooses exact quartiles or
    those of a sketch."""
    columns = list(columns or numeric_columns(df))
    quantiles = {"exact": exact_quantiles, "approx": approx_quantiles}[method]
    found = quantiles(df, dict.fromkeys(columns, list(QUARTILES.values())))
    records, summaries = [], []
    for i, c in enumerate(columns):
        v = f"v{i}"
        summaries.append(
            F.struct(
                F.count(v).cast("double").alias("count"),
                F.avg(v).alias("mean"),
                F.stddev(v).alias("stddev"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            ).alias(v)
        )
        metrics = {m: F.col(f"{v}.{m}") for m in ("count", "mean", "stddev", "min")}
        metrics |= {m: F.lit(q).cast("double") for m, q in zip(QUARTILES, found[c])}
        metrics["max"] = F.col(f"{v}.max")
        records += numeric_records(c, metrics)
    return _unfold(as_numbers(df, columns).agg(*summaries), records)


def numeric_records(column: str, metrics: Mapping[str, Column]) -> list[Column]:
    return [
        F.struct(F.lit(column).alias("column"), F.lit(m).alias("metric"), v.alias("value"))
        for m, v in metrics.items()
    ]


def profile_categories(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_values: int = 20,
    sample: int = 5,
) -> DataFrame:
    """Text columns with at most ``max_values`` distinct values (NULL counts as one) are
    listed value by value with exact counts; of the others an approximate distinct count
    (NULL excluded) and ``sample`` of their values are given.

    Output: (column, listed, n_distinct, value, count). The first pass keeps one sketch
    per column. Only columns it shows to be narrow are grouped by value, so identifiers
    are never shuffled; of the others tasks exchange hashes, and whole values are read
    only where they are the sample.
    """
    columns = list(columns or text_columns(df))
    df = df.select(*[F.col(quoted(c)) for c in columns])
    registers, error = _sketch_size(max_values)
    row = df.agg(*[F.approx_count_distinct(quoted(c), error) for c in columns]).first()
    estimates = dict(zip(columns, row))
    # n values fill at most n registers, so n values cannot read more than this.
    limit = math.ceil(registers * math.log(registers / (registers - max_values)))
    narrow = [c for c in columns if estimates[c] <= limit]
    if not narrow:
        return _samples(df, estimates, sample)
    counted = materialise(
        df.select(*[F.col(quoted(c)) for c in narrow])
        .unpivot([], [quoted(c) for c in narrow], "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count")),
        "categories",
    )
    sizes = dict(counted.groupBy("column").count().collect())
    listed = [c for c in narrow if 0 < sizes.get(c, 0) <= max_values]
    exact = counted.filter(F.col("column").isin(listed)).withColumn(
        "n_distinct", F.count(F.lit(1)).over(Window.partitionBy("column"))
    )
    listing = exact.select("column", F.lit(True).alias("listed"), "n_distinct", "value", "count")
    wide = {c: n for c, n in estimates.items() if c not in narrow or sizes.get(c, 0) > max_values}
    return listing.unionByName(_samples(df, wide, sample)) if wide else listing


def _sketch_size(max_values: int) -> tuple[int, float]:
    """Registers of a distinct-count sketch that counts ``max_values`` by its empty
    registers (at least three in four stay empty), and its relative standard deviation."""
    bits = max(9, math.ceil(math.log2(4 * max_values)))
    return 2**bits, 1.1061 / 2 ** (bits / 2)


def _samples(df: DataFrame, estimates: Mapping[str, int], sample: int) -> DataFrame:
    """Rows of the category profile for columns that are not listed.

    Hashes are split into classes and each class keeps its smallest, so the sample is the
    same however the rows are partitioned.
    """
    classes = 2 * sample
    names = list(estimates)
    hashes = df.select(*[F.xxhash64(quoted(c)).alias(f"h{i}") for i, c in enumerate(names)])
    smallest = [
        F.array(
            *[F.min(F.when(F.pmod(f"h{i}", F.lit(classes)) == k, F.col(f"h{i}"))) for k in range(classes)]
        )
        for i in range(len(names))
    ]
    null = df.sparkSession.range(1).select(F.xxhash64(F.lit(None).cast("string"))).first()[0]
    # A few columns at a time, so that the aggregates stay small enough to compile.
    found = [a for i in range(0, len(names), 5) for a in hashes.agg(*smallest[i : i + 5]).first()]
    chosen = [[h for h in array if h is not None and h != null][:sample] for array in found]
    picked = df.select(
        *[
            F.when(F.xxhash64(quoted(c)).isin(some), F.col(quoted(c))).alias(f"v{i}")
            for i, (c, some) in enumerate(zip(names, chosen))
        ]
    )
    labels = F.array(*[F.lit(c) for c in names])
    counts = F.array(*[F.lit(estimates[c]).cast("bigint") for c in names])
    index = F.substring("column", 2, 9).cast("int")
    return (
        picked.unpivot([], picked.columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .select(
            F.get(labels, index).alias("column"),
            F.lit(False).alias("listed"),
            F.get(counts, index).alias("n_distinct"),
            "value",
            F.lit(None).cast("bigint").alias("count"),
        )
    )
