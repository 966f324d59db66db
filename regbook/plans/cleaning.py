"""The cleaning plan: learn limits and label counts once, then apply them lazily.

``fit_cleaning`` runs the few aggregates whose results later steps depend on. Text work
happens once: with ``stage=True`` the parsed and standardised rows are written as Parquet
first, and the quartile and label passes read one or two columns of
that table instead of parsing the source again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import is_missing
from ..operators.cleaning import (
    add_age,
    add_date_parts,
    dedup,
    drop_uninformative,
    fill_missing,
    keep_in_range,
    keep_ordered,
    require,
    standardise_text,
)
from ..operators.groups import GroupTable
from ..operators.labels import fold_counted, fold_labels, is_rare, label_counts
from ..operators.outliers import IqrBound, iqr_bounds, within_bounds
from ..schema import OTHER, SENTINELS, UNINFORMATIVE, UNKNOWN
from ..storage import materialise


@dataclass(frozen=True)
class CleaningConfig:
    """What to clean. Defaults are the vehicle-registry preset."""

    as_of: int = 2026
    year_column: str = "MAKE_YEAR"
    year_range: tuple[int, int] = (1900, 2026)
    date_column: str = "D_REG"
    ordered: tuple[str, str] = ("OWN_WEIGHT", "TOTAL_WEIGHT")
    iqr_columns: tuple[str, ...] = ("CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT")
    iqr_k: float = 3.0
    iqr_floor: float | None = 0.0
    quantiles: str = "exact"
    sentinels: tuple[str, ...] = SENTINELS
    uninformative: tuple[str, ...] = UNINFORMATIVE
    label_column: str = "BRAND"
    label_min_count: int = 10
    label_other: str = OTHER
    fills: Mapping[str, object] = field(default_factory=lambda: {"CAPACITY": 0.0})
    required: tuple[str, ...] = ("OWN_WEIGHT", "TOTAL_WEIGHT")
    text_fill: str = UNKNOWN
    # "row" compares the columns that are left after the identifying ones are gone, so
    # two alike vehicles count once; "identity" compares whole rows, before anything is
    # measured, so copies do not weigh on limits and label counts either.
    dedup_on: str = "row"


@dataclass(frozen=True)
class FittedCleaning:
    """The rows to clean with what was learned from them. ``source`` still has every
    column and copy; ``standardised`` has what the later steps work on."""

    config: CleaningConfig
    source: DataFrame
    standardised: DataFrame
    bounds: tuple[IqrBound, ...]
    labels: GroupTable | None


def _standardise(df: DataFrame, config: CleaningConfig) -> DataFrame:
    """Everything that depends on a single row and removes none."""
    return _with_features(df.transform(standardise_text, None, config.sentinels), config)


def _with_features(df: DataFrame, config: CleaningConfig) -> DataFrame:
    df = df.transform(add_age, config.year_column, config.as_of)
    return df.transform(add_date_parts, config.date_column)


def _in_domain(df: DataFrame, config: CleaningConfig) -> DataFrame:
    """Rows that break no logical rule."""
    if config.year_column in df.columns:
        df = keep_in_range(df, config.year_column, *config.year_range)
    if set(config.ordered) <= set(df.columns):
        df = keep_ordered(df, *config.ordered)
    return df


def survivors(fitted: FittedCleaning) -> DataFrame:
    """Rows left after the logical rules and the outlier limits."""
    return within_bounds(_in_domain(fitted.standardised, fitted.config), fitted.bounds)


def fit_cleaning(
    df: DataFrame, config: CleaningConfig = CleaningConfig(), stage: bool = False
) -> FittedCleaning:
    """Learn outlier limits and label counts. ``stage`` writes the standardised rows to
    the shared folder first; use it when the source is text or an expensive query."""
    source = _standardise(df, config)
    standardised = source
    if config.dedup_on == "identity":
        # Features follow from the other columns, so they need not be compared or shuffled.
        added = [c for c in source.columns if c not in df.columns]
        standardised = _with_features(dedup(source.drop(*added)), config)
    standardised = drop_uninformative(standardised, config.uninformative)
    if stage:
        standardised = materialise(standardised, "standardised")
    bounds = iqr_bounds(
        _in_domain(standardised, config),
        config.iqr_columns,
        config.iqr_k,
        config.iqr_floor,
        config.quantiles,
    )
    fitted = FittedCleaning(config, source, standardised, tuple(bounds), None)
    if config.label_column not in standardised.columns:
        return fitted
    return replace(fitted, labels=label_counts(survivors(fitted), config.label_column))


def apply_cleaning(fitted: FittedCleaning) -> DataFrame:
    """The clean table, lazily."""
    config = fitted.config
    return _filled(fitted) if config.dedup_on == "identity" else dedup(_filled(fitted))


def _filled(fitted: FittedCleaning) -> DataFrame:
    config, df = fitted.config, survivors(fitted)
    if fitted.labels is not None:
        df = fold_labels(
            df, config.label_column, fitted.labels, config.label_min_count, config.label_other
        )
    df = require(df.transform(fill_missing, config.fills), config.required)
    return fill_missing(df, text=config.text_fill)


def clean_registry(
    df: DataFrame, config: CleaningConfig = CleaningConfig(), stage: bool = False
) -> DataFrame:
    """Standardise, drop impossible and extreme rows, fold rare labels, fill, dedup."""
    return apply_cleaning(fit_cleaning(df, config, stage))


def _value_rules(fitted: FittedCleaning) -> list[tuple[str, str, object, object, Column]]:
    """(rule, column, lower, upper, whether a row breaks it) in the order of removal."""
    config, df = fitted.config, fitted.standardised
    rules = []
    if config.year_column in df.columns:
        low, high = config.year_range
        year = F.col(config.year_column)
        rules.append(("range", config.year_column, float(low), float(high), (year < low) | (year > high)))
    if set(config.ordered) <= set(df.columns):
        low, high = config.ordered
        rules.append(("order", high, None, None, F.col(high) < F.col(low)))
    for b in fitted.bounds:
        rules.append(("outlier", b.column, float(b.lower), float(b.upper), ~b.keeps()))
    return [(*rule, F.coalesce(flagged, F.lit(False))) for *rule, flagged in rules]


def _first_flags(rules) -> list[Column]:
    """How many rows each rule is the first to flag."""
    remaining, counts = F.lit(True), []
    for i, (*_, flagged) in enumerate(rules):
        counts.append(F.count_if(remaining & flagged).alias(f"n{i}"))
        remaining = remaining & ~flagged
    return counts


def audit_cleaning(fitted: FittedCleaning) -> DataFrame:
    """How many rows each removal flags among the rows that earlier ones left:
    (step, rule, column, lower, upper, rows_flagged). One pass counts all value rules;
    duplicates need the same shuffle as removing them."""
    config, df = fitted.config, fitted.standardised
    rules = _value_rules(fitted)
    identity = config.dedup_on == "identity"
    first = 2 if identity else 1
    records = [_audit_record(first + i, *rule, F.col(f"n{i}")) for i, (*rule, _) in enumerate(rules)]
    copies = _count_copies(fitted.source if identity else _filled(fitted))
    step = 1 if identity else first + len(rules)
    duplicates = copies.select(
        F.inline(F.array(_audit_record(step, "duplicate", None, None, None, F.col("copies"))))
    )
    if not rules:
        return duplicates
    return df.agg(*_first_flags(rules)).select(F.inline(F.array(*records))).unionByName(duplicates)


class Audit:
    """What a cleaning run removed and changed, observed while the clean table is computed:
    ``table`` may be asked for once an action on that table has ended."""

    def __init__(self, fitted: FittedCleaning):
        self.fitted = fitted
        self.rules = _value_rules(fitted)
        self.start, self.kept, self.end = (Observation() for _ in range(3))

    def clean(self) -> DataFrame:
        """The clean table, lazily; the same rows as ``apply_cleaning`` gives."""
        config = self.fitted.config
        rows = self.fitted.standardised.observe(self.start, F.count(F.lit(1)).alias("n"), *_first_flags(self.rules))
        rows = survivors(replace(self.fitted, standardised=rows))
        folded = F.lit(0)
        if self.fitted.labels is not None:
            rows = self.fitted.labels.attach(rows)
            folded = F.count_if(is_rare(config.label_column, config.label_min_count))
        rows = rows.transform(fill_missing, config.fills)
        present = [c for c in config.required if c in rows.columns]
        lacking = F.lit(False)
        for c in present:
            lacking = lacking | is_missing(rows, c)
        rows = rows.observe(self.kept, folded.alias("folded"), F.count_if(lacking).alias("lacking"))
        if self.fitted.labels is not None:
            rows = fold_counted(rows, config.label_column, config.label_min_count, config.label_other)
        rows = fill_missing(require(rows, config.required), text=config.text_fill)
        if config.dedup_on != "identity":
            rows = dedup(rows)
        return rows.observe(self.end, F.count(F.lit(1)).alias("n"))

    def records(self) -> list[tuple]:
        """(step, rule, column, lower, upper, rows_flagged, rows_left) from input to output.
        *fold* changes rows and removes none."""
        config, start, kept, out = self.fitted.config, self.start.get, self.kept.get, self.end.get["n"]
        left = start["n"]
        records = [(0, "input", None, None, None, 0, left)]
        for i, (rule, column, low, high, _) in enumerate(self.rules):
            left -= start[f"n{i}"]
            records.append((i + 1, rule, column, low, high, start[f"n{i}"], left))
        step = len(records)
        if self.fitted.labels is not None:
            records.append((step, "fold", config.label_column, None, None, kept["folded"], left))
        left -= kept["lacking"]
        records.append((len(records), "required", ",".join(config.required), None, None, kept["lacking"], left))
        if config.dedup_on != "identity":
            records.append((len(records), "duplicate", None, None, None, left - out, out))
        return records

    def adds_up(self, rows_in: int, rows_out: int) -> bool:
        """Whether the observed figures fit what was read and written. They do unless tasks
        that had been counted were run again, after executors were lost."""
        records = self.records()
        return (records[0][-1], records[-1][-1], self.end.get["n"]) == (rows_in, rows_out, rows_out)

    def table(self) -> DataFrame:
        spark = self.fitted.standardised.sparkSession
        return spark.createDataFrame(self.records(), AUDIT)


AUDIT = "step int, rule string, column string, lower double, upper double, rows_flagged bigint, rows_left bigint"


def write_audited(fitted: FittedCleaning, write: Callable[[DataFrame], DataFrame], tries: int = 3) -> tuple[DataFrame, DataFrame]:
    """The written clean table and its audit, from one pass. ``write`` writes a table and
    returns it as read back; if the figures do not add up it is done again."""
    rows_in = fitted.standardised.count()
    for _ in range(tries):
        audit = Audit(fitted)
        written = write(audit.clean())
        if audit.adds_up(rows_in, written.count()):
            return written, audit.table()
    raise RuntimeError("the counts of the cleaning steps do not add up")


def _audit_record(step, rule, column, lower, upper, flagged: Column) -> Column:
    return F.struct(
        F.lit(step).alias("step"),
        F.lit(rule).alias("rule"),
        F.lit(column).cast("string").alias("column"),
        F.lit(lower).cast("double").alias("lower"),
        F.lit(upper).cast("double").alias("upper"),
        flagged.alias("rows_flagged"),
    )


def _count_copies(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one, as column ``copies``."""
    groups = df.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return groups.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("copies"))
