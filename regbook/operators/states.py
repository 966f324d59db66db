"""All profiles of a table from one pass over its rows.

Every figure of a profile has a state that can be merged: counts, moments, quantile
sketches, distinct-count sketches, and the frequent values of a column with their counts.
One aggregate feeds all of them at once. Tasks' states meet in groups and only the groups'
states in one place; what is left is one row, from which the profiles are unfolded without
reading the table again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.columns import is_missing, number_type, numeric_columns, quoted, text_columns
from ..storage import materialise
from .distribution import Extent
from .profiling import QUARTILES, numeric_records, profile_schema
from .quantiles import SKETCH_SIZE, merged_state, partition_group, sketch_quantiles, sketch_state

# log2 of the registers of a distinct-count sketch: a standard error of 1.6 %.
DISTINCT_BITS = 12
# Classes of hashes of which each keeps one value; the sample comes from the first ones.
SAMPLE_CLASSES = 10


def _moments(column: Column) -> Column:
    return F.struct(
        F.count(column).alias("n"), F.avg(column).alias("mean"), (F.var_pop(column) * F.count(column)).alias("square")
    )


def _merged_moments(state: str) -> Column:
    """Aggregate: (n, mean, square) of all groups, added up one by one; there are as many as
    ``GROUPS`` at most."""
    start = "named_struct('n', 0L, 'mean', 0D, 'square', 0D)"
    return F.expr(
        f"""aggregate(filter(collect_list({state}), s -> s.n > 0), {start}, (a, b) -> named_struct(
          'n', a.n + b.n,
          'mean', a.mean + (b.mean - a.mean) * b.n / (a.n + b.n),
          'square', a.square + b.square + (b.mean - a.mean) * (b.mean - a.mean) * a.n * b.n / (a.n + b.n)))"""
    )


@dataclass(frozen=True)
class TableProfile:
    """The figures of one table: ``row`` holds them all, the methods lay them out."""

    table: DataFrame
    row: DataFrame
    numeric: tuple[str, ...]
    text: tuple[str, ...]
    max_values: int
    sample: int

    def _unfold(self, records: Sequence[Column], schema: str) -> DataFrame:
        if not records:
            return self.row.sparkSession.createDataFrame([], schema)
        return self.row.select(F.inline(F.array(*records)))

    def shape(self) -> DataFrame:
        return self.row.select("n_rows", F.lit(len(self.table.columns)).cast("bigint").alias("n_columns"))

    def schema(self) -> DataFrame:
        return profile_schema(self.table)

    def missing(self) -> DataFrame:
        """(column, n_missing): NULL, or NaN where the type has one."""
        columns = self.table.columns
        records = [
            F.struct(F.lit(c).alias("column"), F.col(f"missing{i}").alias("n_missing")) for i, c in enumerate(columns)
        ]
        return self._unfold(records, "column string, n_missing bigint")

    def numeric_summary(self) -> DataFrame:
        """(column, metric, value) as ``profile_numeric`` gives it, quartiles by a sketch."""
        records = []
        for i, c in enumerate(self.numeric):
            state = f"moments{i}"
            n = F.col(f"{state}.n")
            metrics = {
                "count": n.cast("double"),
                "mean": F.when(n > 0, F.col(f"{state}.mean")),
                "stddev": F.when(n > 1, F.sqrt(F.col(f"{state}.square") / (n - 1))),
                "min": F.col(f"low{i}").cast("double"),
            }
            metrics |= {m: F.get(f"quartiles{i}", F.lit(j)).cast("double") for j, m in enumerate(QUARTILES)}
            metrics["max"] = F.col(f"high{i}").cast("double")
            records += numeric_records(c, metrics)
        return self._unfold(records, "column string, metric string, value double")

    def extents(self) -> dict[str, Extent]:
        """What ``histogram`` and ``density`` need to know first, for columns that have values
        (and no infinite ones)."""
        found = self.row.select(
            *[F.struct(f"moments{i}.n", f"low{i}", f"high{i}", f"moments{i}.square") for i in range(len(self.numeric))]
        ).first()
        out = {}
        for c, (n, low, high, square) in zip(self.numeric, found):
            if n:
                out[c] = Extent(n, float(low), float(high), (square / (n - 1)) ** 0.5 if n > 1 else None)
        return out

    def _listing(self, i: int, column: str) -> Column:
        """The records of one text column: all its values with counts, or a sample."""
        values, distinct = F.col(f"values{i}"), F.col(f"distinct{i}")

        def record(listed: bool, n: Column, value: Column, count: Column) -> Column:
            return F.struct(
                F.lit(column).alias("column"),
                F.lit(listed).alias("listed"),
                n.cast("bigint").alias("n_distinct"),
                value.alias("value"),
                count.cast("bigint").alias("count"),
            )

        narrow = (distinct <= 2 * self.max_values) & (F.size(values) <= self.max_values)
        listed = F.transform(values, lambda v: record(True, F.size(values), v["item"], v["count"]))
        chosen = F.slice(f"sample{i}", 1, self.sample)
        sampled = F.transform(chosen, lambda v: record(False, distinct, v, F.lit(None)))
        return F.when(narrow, listed).otherwise(sampled)

    def categories(self) -> DataFrame:
        """(column, listed, n_distinct, value, count) as ``profile_categories`` gives it."""
        parts = [self._listing(i, c) for i, c in enumerate(self.text)]
        schema = "column string, listed boolean, n_distinct bigint, value string, count bigint"
        if not parts:
            return self.row.sparkSession.createDataFrame([], schema)
        return self.row.select(F.inline(F.flatten(F.array(*parts))))


def profile_states(
    df: DataFrame,
    numeric: Sequence[str] | None = None,
    text: Sequence[str] | None = None,
    max_values: int = 20,
    sample: int = 5,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """The one row of figures, lazily: a scan, an aggregate by task group, and one of those.
    A table without rows gives none.

    For columns with few values the frequent values are all values and their counts exact:
    the state tracks twice as many as are listed before it drops any. For the others each
    class of hashes keeps the value with the least one, whatever the partitions.
    """
    numeric = list(numeric_columns(df) if numeric is None else numeric)
    text = list(text_columns(df) if text is None else text)
    kinds = [number_type(df, c) for c in numeric]
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}

    def number(c: str, kind: str) -> Column:
        value = F.col(quoted(c)).cast(kind)
        return F.when(~F.isnan(value), value) if c in floats else value

    texts = [F.col(quoted(c)) for c in text]
    prepared = df.select(
        *[is_missing(df, c).alias(f"m{i}") for i, c in enumerate(df.columns)],
        *[number(c, kind).alias(f"v{i}") for i, (c, kind) in enumerate(zip(numeric, kinds))],
        *[t.alias(f"t{i}") for i, t in enumerate(texts)],
        *[F.xxhash64(t).alias(f"h{i}") for i, t in enumerate(texts)],
    )
    # A power of two of which three quarters are kept before any is dropped.
    tracked = 1 << (4 * max_values - 1).bit_length()
    first = [F.count(F.lit(1)).alias("n_rows")]
    last = [F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")]
    out = [F.col("n_rows")]
    for i in range(len(df.columns)):
        first.append(F.count_if(f"m{i}").alias(f"missing{i}"))
        last.append(F.coalesce(F.sum(f"missing{i}"), F.lit(0)).alias(f"missing{i}"))
        out.append(F.col(f"missing{i}"))
    for i, kind in enumerate(kinds):
        v = F.col(f"v{i}")
        first += [
            _moments(v.cast("double")).alias(f"moments{i}"),
            F.min(v).alias(f"low{i}"),
            F.max(v).alias(f"high{i}"),
            sketch_state(v, kind, size).alias(f"sketch{i}"),
        ]
        last += [
            _merged_moments(f"moments{i}").alias(f"moments{i}"),
            F.min(f"low{i}").alias(f"low{i}"),
            F.max(f"high{i}").alias(f"high{i}"),
            merged_state(F.col(f"sketch{i}"), kind, size).alias(f"sketch{i}"),
        ]
        quartiles = F.when(F.col(f"moments{i}.n") > 0, sketch_quantiles(f"sketch{i}", kind, list(QUARTILES.values())))
        out += [F.col(f"moments{i}"), F.col(f"low{i}"), F.col(f"high{i}"), quartiles.alias(f"quartiles{i}")]
    for i in range(len(text)):
        t, h = F.col(f"t{i}"), F.col(f"h{i}")
        present = t.isNotNull()
        kept = [
            F.min(F.when(present & (F.pmod(h, F.lit(SAMPLE_CLASSES)) == k), F.struct(h.alias("h"), t.alias("t"))))
            for k in range(SAMPLE_CLASSES)
        ]
        first += [
            F.hll_sketch_agg(t, F.lit(DISTINCT_BITS)).alias(f"distinct{i}"),
            F.expr(f"approx_top_k_accumulate(t{i}, {tracked})").alias(f"values{i}"),
            *[k.alias(f"kept{i}_{j}") for j, k in enumerate(kept)],
        ]
        last += [
            F.hll_union_agg(f"distinct{i}").alias(f"distinct{i}"),
            F.expr(f"approx_top_k_combine(values{i}, {tracked})").alias(f"values{i}"),
            *[F.min(f"kept{i}_{j}").alias(f"kept{i}_{j}") for j in range(SAMPLE_CLASSES)],
        ]
        samples = F.array_compact(F.array(*[F.col(f"kept{i}_{j}.t") for j in range(SAMPLE_CLASSES)]))
        out += [
            F.when(F.col("n_rows") > 0, F.hll_sketch_estimate(f"distinct{i}")).alias(f"distinct{i}"),
            F.when(F.col("n_rows") > 0, F.expr(f"approx_top_k_estimate(values{i}, {max_values + 1})")).alias(f"values{i}"),
            samples.alias(f"sample{i}"),
        ]
    groups = prepared.groupBy(partition_group().alias("part")).agg(*first)
    # Not a global aggregate: that would merge frequent values of no rows at all, and fail.
    return groups.groupBy(F.lit(0).alias("whole")).agg(*last).select(*out)


def _nothing(name: str):
    """The figure of that name for a table without rows."""
    if name.startswith(("n_rows", "missing")):
        return 0
    if name.startswith(("values", "sample")):
        return []
    return (0, None, None) if name.startswith("moments") else None


def profile_table(
    df: DataFrame,
    numeric: Sequence[str] | None = None,
    text: Sequence[str] | None = None,
    max_values: int = 20,
    sample: int = 5,
) -> TableProfile:
    """Shape, missing values, numeric summary and categories of a table, for one pass over
    it. An empty table has no values; infinite numbers count as numbers."""
    numeric = tuple(numeric_columns(df) if numeric is None else numeric)
    text = tuple(text_columns(df) if text is None else text)
    row = materialise(profile_states(df, numeric, text, max_values, sample), "profile")
    if row.isEmpty():
        row = df.sparkSession.createDataFrame([tuple(_nothing(c) for c in row.columns)], row.schema)
    return TableProfile(df, row, numeric, text, max_values, sample)
