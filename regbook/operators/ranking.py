"""Top-k, leaders, first rows and running figures.

Row data is aggregated before any ranking window sees it, so a window's partition holds
one row per distinct value rather than one row per record. Group totals need no window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..storage import materialise
from .aggregates import count_by
from .groups import group_table, with_group_values
from .quantiles import partition_group

# Values that a frequency sketch tracks. Whatever it does not report has at most the share
# ``SKETCH_SHARE / tracked`` of all rows; that is the sketch's own guarantee.
TRACKED = 8_192
SKETCH_SHARE = 3.5
# Rows that one window may order.
WINDOW_ROWS = 1_000_000
_TRACKED_TYPES = ("string", "tinyint", "smallint", "int", "bigint", "float", "double", "date")


def top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of ``key``; equal counts go by key."""
    return count_by(df, [key]).orderBy(F.desc("count"), F.asc(key)).limit(n)


def top_groups_sketched(df: DataFrame, key: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """``top_groups`` for a key with very many values, most of which are rare.

    A sketch proposes the frequent values, and only these are counted, so the others are
    never shuffled. A value it does not report cannot be more frequent than its guarantee
    says; if the last of the ``n`` counts is not above that, all values are counted
    instead. ``tracked`` is a power of two.
    """
    if dict(df.dtypes)[key] not in _TRACKED_TYPES or n > tracked // 2:
        return top_groups(df, key, n)
    column = quoted(key)
    states = df.groupBy(partition_group().alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate({column}, {tracked})").alias("state")
    )
    merged = states.groupBy(F.lit(0).alias("whole")).agg(
        F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(state, {tracked})").alias("state")
    )
    values = F.expr(f"approx_top_k_estimate(state, {tracked // 2})")
    proposed = materialise(merged.select("rows", values.alias("values")), "frequent")
    total = proposed.select("rows").first()
    if total is None:
        return top_groups(df, key, n)
    # At most half as many values as the sketch tracks.
    candidates = F.broadcast(proposed.select(F.explode("values.item").alias("__candidate")))
    kept = df.join(candidates, F.col(column).eqNullSafe(F.col("__candidate")), "left_semi")
    counted = materialise(top_groups(kept, key, n), "leaders")
    last = counted.agg(F.count(F.lit(1)), F.min("count")).first()
    if last[0] == n and last[1] > SKETCH_SHARE / tracked * total["rows"]:
        return counted
    return top_groups(df, key, n)


def top_rows(df: DataFrame, order: Sequence[Column], n: int, tie_break: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order``; ties go by ``tie_break``."""
    return df.orderBy(*order, *[F.asc(c) for c in tie_break]).limit(n)


def leaders_per_group(df: DataFrame, group: str, item: str, limit: int | None = None) -> DataFrame:
    """The most frequent ``item`` of each group; items tied for first place all stay. What is
    first is what has the group's highest count, so no window orders a group's items."""
    counts = materialise(count_by(df, [group, item]), "counts")
    highest = group_table(counts, [group], {"__highest": F.max("count")}).attach(counts, limit)
    leaders = highest.filter(F.col("count") == F.col("__highest")).drop("__highest")
    return leaders.withColumn("rank", F.lit(1))


def first_per_group(
    df: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str],
    value: str,
    largest: bool = False,
    reduce_first: bool = True,
) -> DataFrame:
    """For each group the ``carry`` columns and ``value`` of its first row by ``value``;
    ties go by ``carry``. Ascending order puts a NULL value first, descending last.

    Rows are first reduced to the best value per (keys, carry) with a plain hash
    aggregate, which keeps the result and spares sorting the full input. When ``carry``
    is nearly unique that reduces nothing: pass ``reduce_first=False``, and each task
    sorts its rows and passes on one per group.
    """
    rows = df.select(*keys, *carry, value)
    if reduce_first:
        rows = _best_per_carry(rows, [*keys, *carry], value, largest)
    direction = F.desc_nulls_last(value) if largest else F.asc_nulls_first(value)
    order = Window.partitionBy(*keys).orderBy(direction, *[F.asc(c) for c in carry])
    numbered = rows.withColumn("__position", F.row_number().over(order))
    return numbered.filter(F.col("__position") == 1).drop("__position")


def _best_per_carry(df: DataFrame, keys: Sequence[str], value: str, largest: bool) -> DataFrame:
    if largest:
        return df.groupBy(*keys).agg(F.max(value).alias(value))
    best = df.groupBy(*keys).agg(
        F.min(value).alias("__best"), F.max(F.col(value).isNull()).alias("__has_null")
    )
    return best.select(*keys, F.when(~F.col("__has_null"), F.col("__best")).alias(value))


def above_group_mean(
    df: DataFrame, keys: Sequence[str], column: str, name: str, limit: int | None = None
) -> DataFrame:
    """Rows strictly above their group's mean, with the mean attached."""
    averaged = with_group_values(df, keys, {name: F.avg(column)}, limit)
    return averaged.filter(F.col(column) > F.col(name))


def gap_to_group_min(
    df: DataFrame, keys: Sequence[str], column: str, name: str, limit: int | None = None
) -> DataFrame:
    """Every row with the distance of ``column`` to its group's minimum."""
    lowest = with_group_values(df, keys, {"__lowest": F.min(column)}, limit)
    return lowest.withColumn(name, F.col(column) - F.col("__lowest")).drop("__lowest")


def share_within(
    df: DataFrame, group: str, item: str, digits: int = 2, limit: int | None = None
) -> DataFrame:
    """Count of each item, the total of its group and the percentage. Totals are joined
    to the counts, so a group may have any number of items."""
    counts = materialise(count_by(df, [group, item]), "counts")
    totals = group_table(counts, [group], {"total": F.sum("count")})
    share = F.round(F.col("count") / F.col("total") * 100, digits)
    return totals.attach(counts, limit).withColumn("percentage", share)


def running_count(df: DataFrame, group: str, order: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Count per (group, order) and its running total; a NULL order value comes first.

    Up to ``window_rows`` counts are ordered in windows. More are range partitioned into
    blocks by group and order: a running total within the block, plus the sums of the
    group's earlier blocks. So a group of any size, with any number of order values, is
    never ordered in one task.
    """
    counts = materialise(count_by(df, [group, order]), "counts")
    if counts.count() <= window_rows:
        so_far = Window.partitionBy(group).orderBy(F.asc_nulls_first(order))
        return counts.withColumn("running_total", F.sum("count").over(so_far))
    return running_total(counts, group, order, "count", "running_total")


def running_total(df: DataFrame, group: str, order: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the group's rows up to each one's ``order``, rows
    of equal order counted in. Rows of one (group, order) must fit in a task."""
    dealt = df.repartitionByRange(F.asc_nulls_first(group), F.asc_nulls_first(order))
    blocks = materialise(dealt.withColumn("__block", F.spark_partition_id()), "blocks")
    # One row for each group of a block: blocks + groups rows at most, blocks for one group.
    sums = blocks.groupBy(F.col(group).alias("__group"), F.col("__block").alias("__of")).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy("__group").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    # Only a group that continues in a later block has anything to carry over.
    carried = sums.withColumn("__before", F.sum("__sum").over(earlier)).filter("__before IS NOT NULL").drop("__sum")
    within = Window.partitionBy("__block", group).orderBy(F.asc_nulls_first(order))
    totals = blocks.withColumn("__within", F.sum(value).over(within))
    joined = totals.join(
        F.broadcast(materialise(carried, "carried")),  # a row for each border between blocks
        (F.col("__block") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group")),
        "left",
    )
    total = F.col("__within") + F.coalesce(F.col("__before"), F.lit(0))
    return joined.select(*df.columns, total.alias(name))
