"""Histogram, density curve and correlation matrix from aggregates.

The only values that reach the driver are a column's count, minimum, maximum and
deviation; they return to the plan as literals.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_numbers, numeric_columns

# A density bin is never wider than this share of the bandwidth.
BIN_SHARE = 0.125
DENSITY_BINS = 512
# Bandwidths beyond which a value adds nothing to a curve: exp(-9 ** 2 / 2) < 1e-17.
KERNEL_REACH = 9.0
# Groups in which the states of tasks meet before they are merged in one place.
MERGE_GROUPS = 32


@dataclass(frozen=True)
class Extent:
    """Number, limits and standard deviation of a column's finite values."""

    n: int
    low: float
    high: float
    spread: float | None


def _finite(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Numbers that have a place on an axis, named by position; NaN and infinite values
    become NULL."""
    numbers = as_numbers(df, columns)
    return numbers.select(
        *[F.when(F.abs(c) < F.lit(math.inf), F.col(c)).alias(c) for c in numbers.columns]
    )


def extents(df: DataFrame, columns: Sequence[str]) -> dict[str, Extent]:
    """Extent of each column that has a value."""
    names = [f"v{i}" for i in range(len(columns))]
    measures = [F.struct(F.count(v), F.min(v), F.max(v), F.stddev_samp(v)).alias(v) for v in names]
    row = _finite(df, columns).agg(*measures).first()
    return {c: Extent(*row[v]) for c, v in zip(columns, names) if row[v][0] > 0}


def _edges(low: float, high: float, bins: int) -> tuple[float, float]:
    """First edge and bin width; a constant column gets a unit range around it."""
    if low == high:
        low, high = low - 0.5, high + 0.5
    return low, (high - low) / bins


def _binned(df: DataFrame, found: dict[str, Extent], bins: Mapping[str, int]) -> DataFrame:
    """(column, bin, count, mean) for the bins that hold a value. Bins are zero-based and
    half-open, and the last one includes its right edge."""
    values = _finite(df, found)
    names = [f"v{i}" for i in range(len(found))]
    edges = {v: (*_edges(e.low, e.high, bins[c]), bins[c] - 1) for v, (c, e) in zip(names, found.items())}
    guesses = {
        f"guess_{v}": F.least(F.floor((F.col(v) - low) / width), F.lit(last))
        for v, (low, width, last) in edges.items()
    }
    # The division may land next to the right bin; the edges themselves decide.
    cells = []
    for v, (low, width, last) in edges.items():
        value, guess = F.col(v), F.col(f"guess_{v}")
        before = value < F.lit(low) + guess * F.lit(width)
        after = (value >= F.lit(low) + (guess + 1) * F.lit(width)) & (guess < last)
        exact = F.when(before, guess - 1).when(after, guess + 1).otherwise(guess)
        cells.append(F.struct(exact.alias("bin"), value.alias("value")).alias(v))
    labels = F.array(*[F.lit(c) for c in found])
    return (
        values.withColumns(guesses)
        .select(*cells)
        .unpivot([], names, "column", "cell")
        .filter(F.col("cell.value").isNotNull())
        .groupBy("column", F.col("cell.bin").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"), F.avg("cell.value").alias("mean"))
        .withColumn("column", F.get(labels, F.substring("column", 2, 9).cast("int")))
    )


def histogram(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 30,
    known: Mapping[str, Extent] | None = None,
) -> DataFrame:
    """Equal-width bins between each column's minimum and maximum, empty ones included.

    Output: (column, bin, lower, upper, count). Missing and infinite values are left out.
    ``known`` extents save the pass that finds them.
    """
    found = dict(known) if known is not None else extents(df, columns or numeric_columns(df))
    frame = []
    for c, extent in found.items():
        low, width = _edges(extent.low, extent.high, bins)
        frame += [(c, i, low + i * width, low + (i + 1) * width) for i in range(bins)]
    edges = df.sparkSession.createDataFrame(
        frame, "column string, bin int, lower double, upper double"
    )
    if not found:
        return edges.withColumn("count", F.lit(0).cast("bigint"))
    counts = _binned(df, found, dict.fromkeys(found, bins)).drop("mean")
    counts = counts.withColumn("bin", F.col("bin").cast("int"))
    # The counts have at most one row per column and bin.
    filled = edges.join(F.broadcast(counts), ["column", "bin"], "left")
    return filled.withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))


def density(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    grid: int = 200,
    bandwidth: float | None = None,
    known: Mapping[str, Extent] | None = None,
) -> DataFrame:
    """Gaussian kernel density on ``grid`` points from minimum to maximum.

    The kernel is summed over fine bins, each represented by the mean of its values; bins
    are narrow against the bandwidth, which shrinks as the data grows. A bin meets only the
    points within ``KERNEL_REACH`` bandwidths, so the work after one pass over the data is
    points x near bins. ``bandwidth`` defaults to Scott's rule. Columns without spread have
    no curve; missing and infinite values are left out. ``known`` extents save the pass that
    finds them. Output: (column, point, x, density).
    """
    every = dict(known) if known is not None else extents(df, columns or numeric_columns(df))
    found = {c: e for c, e in every.items() if e.n > 1 and e.spread}
    if not found:
        return df.sparkSession.createDataFrame(
            [], "column string, point int, x double, density double"
        )
    curves, bins = [], {}
    for c, e in found.items():
        h = float(bandwidth) if bandwidth is not None else e.spread * e.n ** -0.2
        step = (e.high - e.low) / (grid - 1)
        bins[c] = max(DENSITY_BINS, math.ceil((e.high - e.low) / (h * BIN_SHARE)))
        curves.append((c, e.low, step, h, 1.0 / (e.n * h * math.sqrt(2 * math.pi))))
    curves = F.broadcast(  # one row per column
        df.sparkSession.createDataFrame(curves, "column string, low double, step double, h double, scale double")
    )
    reach = F.lit(KERNEL_REACH) * F.col("h")
    first = F.greatest(F.lit(0), F.ceil((F.col("mean") - reach - F.col("low")) / F.col("step")))
    last = F.least(F.lit(grid - 1), F.floor((F.col("mean") + reach - F.col("low")) / F.col("step")))
    # A gap between points may be wider than the kernel; then a bin meets none of them.
    near = F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))
    x = F.col("low") + F.col("point") * F.col("step")
    weights = (
        _binned(df, found, bins)
        .join(curves, "column")
        .withColumn("point", F.explode(near))
        .withColumn("u", (x - F.col("mean")) / F.col("h"))
        .groupBy("column", "point")
        .agg(F.sum(F.col("count") * F.exp(-0.5 * F.pow("u", F.lit(2)))).alias("weight"))
    )
    points = curves.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    return points.join(weights, ["column", "point"], "left").select(
        "column", "point", x.alias("x"), (F.coalesce("weight", F.lit(0.0)) * F.col("scale")).alias("density")
    )


STATE = "part int, n array<double>, mean array<double>, square array<double>, product array<double>"


class CoMoments:
    """Co-moments of every ordered pair of columns over the rows that have both: number of
    rows, mean and sum of squares of the first column, and sum of products, as matrices."""

    def __init__(self, size: int):
        self.n, self.mean, self.square, self.product = np.zeros((4, size, size))

    @classmethod
    def of(cls, values: np.ndarray) -> CoMoments:
        """Of rows x columns, NaN where a value is missing. Values are taken from near their
        column's mean; a column without spread then gives zeros exactly."""
        state = cls(values.shape[1])
        have = ~np.isnan(values)
        first = np.array([c[h][0] if h.any() else 0.0 for c, h in zip(values.T, have.T)])
        near = np.where(have, values - first, 0.0)
        shift = near.sum(axis=0) / np.maximum(have.sum(axis=0), 1)
        near = np.where(have, near - shift, 0.0)
        mask = have.astype(float)
        state.n = mask.T @ mask
        sums = near.T @ mask
        share = np.divide(sums, state.n, out=np.zeros_like(sums), where=state.n > 0)
        state.mean = (first + shift)[:, None] + share
        state.square = (near**2).T @ mask - sums * share
        state.product = near.T @ near - sums * share.T
        return state

    def add(self, other: CoMoments) -> None:
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        # Where one side has no rows the other side's means are the means.
        step = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        self.square += other.square + step**2 * self.n * share
        self.product += other.product + step * step.T * self.n * share
        self.mean = np.where(self.n > 0, self.mean + step * share, other.mean)
        self.n = n

    def row(self, part: int) -> pa.RecordBatch:
        arrays = [pa.array([x.ravel().tolist()], pa.list_(pa.float64())) for x in (self.n, self.mean, self.square, self.product)]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *arrays], names=["part", "n", "mean", "square", "product"])

    @classmethod
    def merged(cls, rows: pa.Table, size: int) -> CoMoments:
        state = cls(size)
        for row in rows.to_pylist():
            other = cls(size)
            other.n, other.mean, other.square, other.product = (
                np.array(row[x]).reshape(size, size) for x in ("n", "mean", "square", "product")
            )
            state.add(other)
        return state


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the co-moments of all pairs, as four flat matrices. Every task makes one
    state of its rows; states meet in ``MERGE_GROUPS`` groups, and those in one."""
    size = len(columns)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = CoMoments(size)
        for batch in batches:
            if batch.num_rows:
                state.add(CoMoments.of(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])))
        yield state.row(TaskContext.get().partitionId() % MERGE_GROUPS)

    def merged(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([CoMoments.merged(rows, size).row(0)])

    states = _finite(df, columns).mapInArrow(of_task, STATE)
    return states.groupBy("part").applyInArrow(merged, STATE).groupBy("part").applyInArrow(merged, STATE)


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every ordered pair over the rows where both have a finite value;
    NULL where a column has no spread there. Output: (x, y, corr)."""
    columns = list(columns or numeric_columns(df))
    labels = F.array(*[F.lit(c) for c in columns])
    if not columns:
        return df.sparkSession.createDataFrame([], "x string, y string, corr double")
    size = F.lit(len(columns))
    turned = (F.col("i") % size) * size + F.floor(F.col("i") / size)
    cells = co_moments(df, columns).select(
        F.posexplode("product").alias("i", "together"), "square"
    )
    spread = F.sqrt(F.get("square", F.col("i"))) * F.sqrt(F.get("square", turned.cast("int")))
    corr = F.try_divide(F.col("together"), spread)
    x, y = F.floor(F.col("i") / size).cast("int"), F.col("i") % size
    limited = F.when(corr.isNotNull() & (x == y), 1.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr)))
    return cells.select(F.get(labels, x).alias("x"), F.get(labels, y).alias("y"), F.when(corr.isNotNull(), limited).alias("corr"))
