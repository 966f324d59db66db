"""Row-wise cleaning and derived features. All of it is one projection or one filter,
so Catalyst fuses a chain of these into a single stage over the scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted, text_columns
from ..schema import SENTINELS, UNINFORMATIVE
from ..storage import materialise
from .groups import broadcast_limit


def standardise_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """Trim and upper-case text; entries that only stand for "missing" become NULL."""
    tidy = {c: F.upper(F.trim(F.col(c))) for c in (columns or text_columns(df))}
    return df.withColumns({c: F.when(~v.isin(*sentinels), v) for c, v in tidy.items()})


def keep_in_range(df: DataFrame, column: str, low, high, keep_null: bool = True) -> DataFrame:
    """Rows whose value lies in ``[low, high]``; NULL stays unless told otherwise."""
    inside = F.col(column).between(low, high)
    return df.filter(F.col(column).isNull() | inside if keep_null else inside)


def keep_ordered(df: DataFrame, low: str, high: str) -> DataFrame:
    """Rows where ``low <= high``, or where either side is unknown."""
    return df.filter(F.coalesce(F.col(low) <= F.col(high), F.lit(True)))


def drop_uninformative(df: DataFrame, columns: Iterable[str] = UNINFORMATIVE) -> DataFrame:
    return df.drop(*columns)


def fill_missing(
    df: DataFrame,
    values: Mapping[str, object] | None = None,
    text: str | None = None,
) -> DataFrame:
    """Constant fills: ``values`` per column (NaN counts as missing), ``text`` for every
    text column. Columns that are absent are ignored."""
    present = {c: v for c, v in (values or {}).items() if c in df.columns}
    if present:
        df = df.fillna(present)
    texts = text_columns(df)
    return df.fillna(text, subset=texts) if text is not None and texts else df


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows where any of the columns that exist is NULL or NaN."""
    present = [c for c in columns if c in df.columns]
    return df.dropna(subset=present) if present else df


def dedup(df: DataFrame) -> DataFrame:
    """One row of each set of identical rows. Copies collapse before the shuffle, so a
    row repeated a billion times sends at most one copy per task."""
    return df.dropDuplicates()


def dedup_wide(df: DataFrame, limit: int | None = None, bits: int = 128) -> DataFrame:
    """``dedup`` for wide rows of which few are repeated.

    Rows are first counted by a fingerprint of 16 bytes, and only that is shuffled. A row
    whose fingerprint is its own is unique and stays where it is; rows that share one are
    compared in full. The shared fingerprints are broadcast up to ``limit`` bytes (the
    session's broadcast limit); if more rows repeat than that, whole rows are shuffled.
    ``bits`` cuts fingerprints short, for tests.
    """
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    columns = [F.col(quoted(c)) for c in df.columns]
    marked = [x for c in columns for x in (c.isNull(), c)]
    prints = [F.xxhash64(F.lit(seed), *marked) for seed in (1, 2)]
    if bits < 128:
        prints = [F.pmod(prints[0], F.lit(2**bits)), F.lit(0).cast("bigint")]
    prints = [p.alias(f"__print{i}") for i, p in enumerate(prints)]
    names = ["__print0", "__print1"]
    shared = df.select(*prints).groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*names)
    shared = materialise(shared, "fingerprints")
    if shared.count() * 32 > limit:
        return dedup(df)
    marked_rows = df.select("*", *prints)
    unique = marked_rows.join(F.broadcast(shared), names, "left_anti").select(*columns)
    repeated = marked_rows.join(F.broadcast(shared), names, "left_semi").select(*columns)
    return unique.unionByName(dedup(repeated))


def add_age(df: DataFrame, column: str = "MAKE_YEAR", as_of: int = 2026, name: str = "AGE") -> DataFrame:
    return df.withColumn(name, F.lit(as_of) - F.col(column)) if column in df.columns else df


def add_date_parts(
    df: DataFrame,
    column: str = "D_REG",
    year: str = "REG_YEAR",
    month: str = "REG_MONTH",
) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumns({year: F.year(column), month: F.month(column)})
