"""Attaching a value computed per group to every row of the group.

A window over the group would send all its rows to one task. Here the group values
are aggregated first (map-side combine, tiny shuffle), written once and measured, and
then joined back:

* if the measured table fits the session's broadcast limit, it is broadcast and the
  rows are not shuffled at all;
* otherwise rows and groups meet in a shuffle join, for which a large group is split: its
  measured size says into how many pieces of ``HOT_SHARE`` of all rows, its row of the
  table is repeated that often, and the content of a row decides its piece. Only groups
  with more than one piece - at most ``1 / HOT_SHARE``, so their table is bounded - need to
  be known beforehand, from a broadcast. The rows are read once.

Both ways give every row exactly its group's values.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ..functions.columns import quoted
from ..storage import materialise

HOT_SHARE = 0.001
_ROWS = "__group_rows"
_KEY = "__group_key_"
_PIECE, _PIECES = "__group_piece", "__group_pieces"
_UNITS = {"": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40, "p": 2**50}


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when switched off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)i?b?", text).groups()
    return int(number) * _UNITS[unit]


@dataclass(frozen=True)
class GroupTable:
    """One written row per group: its keys, its number of rows and its values."""

    table: DataFrame
    keys: tuple[str, ...]
    values: tuple[str, ...]
    rows: int
    bytes: int

    @property
    def key_columns(self) -> tuple[str, ...]:
        """The names of the keys within ``table``."""
        return tuple(f"{_KEY}{i}" for i in range(len(self.keys)))

    def attach(self, df: DataFrame, limit: int | None = None) -> DataFrame:
        """Every row of ``df`` with the values of its group. NULL keys form a group, and
        a row whose group is not in the table gets NULL values."""
        limit = broadcast_limit(df.sparkSession) if limit is None else limit
        if self.bytes <= limit:
            return self._join(df, F.broadcast(self.table.drop(_ROWS)), self._same_group())
        pieces = F.ceil(F.col(_ROWS) / max(1.0, self.rows * HOT_SHARE)).cast("int")
        sized = self.table.withColumn(_PIECES, pieces).drop(_ROWS)
        large = F.broadcast(sized.filter(F.col(_PIECES) > 1).select(*self.key_columns, _PIECES))
        # By content, so that a task that is run again deals its rows out as before.
        piece = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in df.columns]), F.col(_PIECES))
        dealt = df.join(large, self._same_group(), "left").withColumn(_PIECE, F.coalesce(piece.cast("int"), F.lit(0)))
        copies = sized.withColumn(f"{_PIECE}_", F.explode(F.sequence(F.lit(0), F.col(_PIECES) - 1))).drop(_PIECES)
        # Compressed files may look small enough to broadcast; the measured size is not.
        same = self._same_group() & (F.col(_PIECE) == F.col(f"{_PIECE}_"))
        return self._join(dealt.drop(*self.key_columns, _PIECES), copies.hint("merge"), same, df.columns)

    def _same_group(self) -> Column:
        pairs = [F.col(quoted(k)).eqNullSafe(F.col(g)) for k, g in zip(self.keys, self.key_columns)]
        return reduce(Column.__and__, pairs)

    def _join(self, df: DataFrame, groups: DataFrame, same: Column, columns: Sequence[str] | None = None) -> DataFrame:
        kept = [F.col(quoted(c)) for c in (df.columns if columns is None else columns)]
        return df.join(groups, same, "left").select(*kept, *self.values)


def group_table(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> GroupTable:
    """Aggregate ``df`` per group and write the result to the shared folder."""
    summary = df.groupBy(*[F.col(quoted(k)).alias(f"{_KEY}{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias(_ROWS), *[v.alias(name) for name, v in values.items()]
    )
    table = materialise(summary, "groups")
    size = table.agg(
        F.coalesce(F.sum(_ROWS), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(table)), F.lit(0)).alias("bytes"),
    ).first()
    return GroupTable(table, tuple(keys), tuple(values), size["rows"], size["bytes"])


def with_group_values(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    limit: int | None = None,
) -> DataFrame:
    """``df`` plus one column per aggregate, computed over the row's group."""
    return group_table(df, keys, values).attach(df, limit)


def _row_bytes(df: DataFrame) -> Column:
    """In-memory size of a row: a fixed slot per column plus the length of its text."""
    sized = [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    fixed = F.lit(16 * (len(df.columns) + 1)).cast("bigint")
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in sized), fixed)
