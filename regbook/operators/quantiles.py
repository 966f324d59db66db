"""Quantiles of columns that do not fit in one task.

Sketches are made in two levels: the sketches of tasks meet in ``GROUPS`` groups, and only
those are merged in one place, so no task receives a sketch from every input task.

``exact_quantiles`` finds order statistics in the column's own type. A sketch proposes a
narrow bracket around each wanted rank; one pass counts where the bracket lies and, while
the few values inside it fit, picks the answer from them at once; otherwise it sketches
them for the next pass, which is some hundred times narrower. The answer never depends on
a sketch being right: the counts decide, and a bracket that misses is replaced.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number_type, own_numbers

# Size of a sketch; its error is ``rank_error(SKETCH_SIZE)``.
SKETCH_SIZE = 8_192
FINISH_ROWS = 100_000
GROUPS = 256
# Quantiles taken from a sketch to choose brackets from.
CUTS = 1_000
# How far a bracket reaches out on either side when the sketch is of other rows.
MARGIN = 0.02


def rank_error(size: int = SKETCH_SIZE) -> float:
    """The rank error, as a share of all values, that a sketch keeps 99 times in 100."""
    return 2.296 / size**0.9723


def partition_group() -> Column:
    """A number below ``GROUPS`` that is the same for all rows of a task."""
    return F.spark_partition_id() % GROUPS


def _suffix(kind: str) -> str:
    return "bigint" if kind == "bigint" else "double"


def sketch_state(column: Column, kind: str, size: int) -> Column:
    """Aggregate: the sketch of a column, NULL if there is nothing in it."""
    make = getattr(F, f"kll_sketch_agg_{_suffix(kind)}")
    value = column.cast("double") if _suffix(kind) == "double" else column
    return F.when(F.count(column) > 0, make(value, F.lit(size)))


def merged_state(state: Column, kind: str, size: int) -> Column:
    """Aggregate: the sketches of ``sketch_state`` as one."""
    return getattr(F, f"kll_merge_agg_{_suffix(kind)}")(state, F.lit(size))


def sketch_quantiles(state: str, kind: str, fractions: Sequence[float]) -> Column:
    """The values of a sketch column at some fractions, NULL without a sketch."""
    ranks = ", ".join(f"{p!r}D" for p in fractions)
    taken = F.expr(f"kll_sketch_get_quantile_{_suffix(kind)}({state}, array({ranks}))")
    return F.when(F.col(state).isNotNull(), taken)


@dataclass(frozen=True)
class Sketched:
    """Evenly spaced quantiles of ``n`` values, good to ``error`` of the rank."""

    n: int
    cuts: Sequence
    error: float


def sketch_columns(df: DataFrame, columns: Sequence[str], size: int = SKETCH_SIZE) -> dict[str, Sketched]:
    """The distribution of several columns, from one pass over the rows."""
    kinds = [number_type(df, c) for c in columns]
    states = [
        s
        for i, kind in enumerate(kinds)
        for s in (F.count(f"v{i}").alias(f"n{i}"), sketch_state(F.col(f"v{i}"), kind, size).alias(f"s{i}"))
    ]
    merged = [
        m
        for i, kind in enumerate(kinds)
        for m in (F.sum(f"n{i}").alias(f"n{i}"), merged_state(F.col(f"s{i}"), kind, size).alias(f"s{i}"))
    ]
    grouped = own_numbers(df, columns).groupBy(partition_group().alias("part")).agg(*states).agg(*merged)
    fractions = [i / CUTS for i in range(CUTS + 1)]
    row = grouped.select(
        *[f"n{i}" for i in range(len(kinds))],
        *[
            F.when(F.col(f"n{i}") > 0, sketch_quantiles(f"s{i}", kind, fractions)).alias(f"q{i}")
            for i, kind in enumerate(kinds)
        ],
    ).first()
    return {
        c: Sketched(row[i] or 0, _own_type(row[len(kinds) + i] or [], kind), rank_error(size))
        for i, (c, kind) in enumerate(zip(columns, kinds))
    }


def _own_type(values: Sequence, kind: str) -> list:
    if not kind.startswith("decimal"):
        return list(values)
    scale = int(kind.rstrip(")").split(",")[1])
    return [Decimal(repr(v)).quantize(Decimal(1).scaleb(-scale)) for v in values]


@dataclass(frozen=True)
class _Search:
    """The value of a rank among those strictly between ``low`` and ``high`` (``None``: no
    limit). Before the first pass the rank is known as a fraction only."""

    column: int
    kind: str
    fraction: float
    inside: int
    cuts: Sequence
    reach: float
    low: object = None
    high: object = None
    rank: int | None = None
    answer: object = None
    solved: bool = False
    bracket: tuple = field(default=(None, None))
    collects: bool = False

    def prepared(self, finish_rows: int) -> _Search:
        """With the bracket and the way of the next pass."""
        if self.inside <= finish_rows:
            return replace(self, bracket=(None, None), collects=True)
        known = self.cuts[bisect_right(self.cuts, self.low) if self.low is not None else 0 :]
        known = known[: bisect_left(known, self.high) if self.high is not None else len(known)]
        if len(known) < 2:
            return replace(self, bracket=(None, None), collects=False)
        share = self.fraction if self.rank is None else self.rank / self.inside
        reach = self.reach * max(1.0, len(self.cuts) / len(known)) if self.rank is not None else self.reach
        reach += 1.5 / len(known)
        last = len(known) - 1
        left = known[max(0, math.floor((share - reach) * last))]
        right = known[min(last, math.ceil((share + reach) * last))]
        # Four times what should lie inside must fit before values are brought together.
        return replace(self, bracket=(left, right), collects=8 * reach * self.inside <= finish_rows)

    def _limit(self, value) -> Column:
        literal = F.lit(value)
        return literal.cast(self.kind) if self.kind.startswith("decimal") else literal

    def measures(self, i: int, size: int) -> tuple[list[Column], list[Column]]:
        """Aggregates of a task group, and what makes one row of them."""
        value = kept = F.col(f"v{self.column}")
        if self.low is not None:
            kept = F.when(value > self._limit(self.low), kept)
        if self.high is not None:
            kept = F.when(value < self._limit(self.high), kept)
        left, right = self.bracket
        if left is None:
            counts, middle = [F.lit(0), F.lit(0), F.count(kept), F.lit(0), F.lit(0)], kept
        else:
            a, b = self._limit(left), self._limit(right)
            between = (kept > a) & (kept < b)
            counts = [
                F.count_if(kept < a),
                F.count_if(kept == a),
                F.count_if(between),
                F.count_if((kept == b) & (kept != a)),
                F.count_if(kept > b),
            ]
            middle = F.when(between, kept)
        names = [f"{x}{i}" for x in "abcde"]
        first = [c.cast("bigint").alias(n) for c, n in zip(counts, names)]
        sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
        if self.collects:
            first.append(F.collect_list(middle).alias(f"m{i}"))
            sums.append(F.sort_array(F.flatten(F.collect_list(f"m{i}"))).alias(f"m{i}"))
        else:
            first.append(sketch_state(middle, self.kind, size).alias(f"m{i}"))
            sums.append(merged_state(F.col(f"m{i}"), self.kind, size).alias(f"m{i}"))
        return first, sums

    def result(self, i: int) -> Column:
        """The counts, and the value of the rank or quantiles of what lies inside."""
        names = [f"{x}{i}" for x in "abcde"]
        if not self.collects:
            cuts = F.when(F.col(f"c{i}") > 0, sketch_quantiles(f"m{i}", self.kind, [j / CUTS for j in range(CUTS + 1)]))
            return F.struct(*names, cuts.alias("found"))
        total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
        rank = F.lit(self.rank) if self.rank is not None else F.greatest(F.lit(1), F.ceil(F.lit(self.fraction) * total))
        place = (rank - F.col(f"a{i}") - F.col(f"b{i}") - 1).cast("int")
        return F.struct(*names, F.when(place >= 0, F.get(f"m{i}", place)).alias("found"))

    def narrowed(self, below: int, at_left: int, between: int, at_right: int, above: int, found) -> _Search:
        """The part of the interval that holds the rank, or the answer."""
        inside = below + at_left + between + at_right + above
        if inside == 0:
            return replace(self, solved=True)
        rank = max(1, math.ceil(self.fraction * inside)) if self.rank is None else self.rank
        left, right = self.bracket
        if rank <= below:
            return replace(self, rank=rank, inside=below, high=left)
        rank -= below
        if rank <= at_left:
            return replace(self, answer=left, solved=True)
        rank -= at_left
        if rank <= between:
            if self.collects:
                return replace(self, answer=found, solved=True)
            low, high = (self.low, self.high) if left is None else (left, right)
            cuts = _own_type(found, self.kind)
            return replace(self, rank=rank, inside=between, low=low, high=high, cuts=cuts)
        rank -= between
        if rank <= at_right:
            return replace(self, answer=right, solved=True)
        return replace(self, rank=rank - at_right, inside=above, low=right)


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    finish_rows: int = FINISH_ROWS,
    size: int = SKETCH_SIZE,
    sketched: Mapping[str, Sketched] | None = None,
) -> dict[str, list]:
    """For each column, the smallest value whose cumulative share reaches each fraction, in
    the column's own type (whole numbers and decimals stay exact).

    NULL and NaN are ignored; an empty column gives ``None``. Only scalars reach the
    driver; a task holds at most ``finish_rows`` values of a search, which the sketch's
    error assures four times over. ``sketched`` saves the first pass. It may come from more
    rows than ``df`` has: then brackets are wider.
    """
    first = sketched if sketched is not None else sketch_columns(df, list(wanted), size)
    margin = 0.0 if sketched is None else MARGIN
    kinds = [number_type(df, c) for c in wanted]
    searches = [
        _Search(i, kinds[i], p, first[c].n, first[c].cuts, first[c].error + margin, solved=first[c].n == 0)
        for i, (c, ps) in enumerate(wanted.items())
        for p in ps
    ]
    numbers = own_numbers(df, wanted)
    while pending := [i for i, s in enumerate(searches) if not s.solved]:
        found = _pass(numbers, [searches[i].prepared(finish_rows) for i in pending], size)
        searches = [found[pending.index(i)] if i in pending else s for i, s in enumerate(searches)]
    answers = iter(searches)
    return {c: [next(answers).answer for _ in ps] for c, ps in wanted.items()}


def _pass(numbers: DataFrame, searches: Sequence[_Search], size: int) -> list[_Search]:
    """One pass over the rows for all searches."""
    measures = [s.measures(i, size) for i, s in enumerate(searches)]
    grouped = numbers.groupBy(partition_group().alias("part")).agg(*[m for first, _ in measures for m in first])
    row = grouped.agg(*[m for _, sums in measures for m in sums])
    row = row.select(*[s.result(i).alias(f"r{i}") for i, s in enumerate(searches)]).first()
    # The next brackets come from sketches of these very rows.
    found = [s.narrowed(*row[i]) for i, s in enumerate(searches)]
    return [s if s.cuts is old.cuts else replace(s, reach=rank_error(size)) for s, old in zip(found, searches)]


def approx_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], size: int = SKETCH_SIZE
) -> dict[str, list]:
    """One pass for all columns; the error of the rank is ``rank_error(size)``."""
    kinds = [number_type(df, c) for c in wanted]
    states = [sketch_state(F.col(f"v{i}"), kind, size).alias(f"s{i}") for i, kind in enumerate(kinds)]
    merged = [merged_state(F.col(f"s{i}"), kind, size).alias(f"s{i}") for i, kind in enumerate(kinds)]
    counts = [F.count(f"v{i}").alias(f"n{i}") for i in range(len(kinds))]
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(kinds))]
    grouped = own_numbers(df, wanted).groupBy(partition_group().alias("part")).agg(*states, *counts).agg(*merged, *sums)
    row = grouped.select(
        *[
            F.when(F.col(f"n{i}") > 0, sketch_quantiles(f"s{i}", kind, list(ps)))
            for i, (kind, ps) in enumerate(zip(kinds, wanted.values()))
        ]
    ).first()
    return {
        c: _own_type(q, kind) if q is not None else [None] * len(ps)
        for (c, ps), kind, q in zip(wanted.items(), kinds, row)
    }
