"""Every operator and question as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import text_columns
from ..functions.parsing import parse_decimal, parse_short_date
from ..operators import aggregates, cleaning, distribution, labels, outliers, profiling, ranking
from ..operators.quantiles import approx_quantiles, rank_error
from ..operators.states import profile_table
from ..plans.cleaning import CleaningConfig, apply_cleaning, audit_cleaning, fit_cleaning, write_audited
from ..plans.explain import plan_report
from ..plans.profiles import profile_run
from ..plans.questions import QUESTIONS
from ..schema import SENTINELS
from ..sinks import read_manifest, write_delimited, write_results
from ..sources import load_registry, read_delimited, read_table
from ..storage import materialise, scratch_path
from .view import AS_OF, TERMS, clean_rows, raw_rows, registry

Query = Callable[[SparkSession, str], DataFrame]

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

# The cleaning preset adapted to the view: narrower limits, so that every rule fires.
VIEW_CLEANING = CleaningConfig(
    as_of=AS_OF,
    year_range=(1996, 2000),
    iqr_k=0.25,
    sentinels=(*SENTINELS, "OLD"),
    label_column="MODEL",
    label_min_count=300,
)


def _question(number: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        answer = QUESTIONS[number](registry(spark, folder))
        if number == 5:
            # Engines add doubles in different orders.
            answer = answer.withColumn("sum_weight", F.round("sum_weight", 2))
        return answer

    return query


def _rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


# --- sources and sinks ---------------------------------------------------------------


def source_parquet(spark, folder):
    return read_table(spark, folder, "orders")


def source_registry_csv(spark, folder):
    """The raw view rendered as registry text, written, and loaded again. The text is
    several times the tables, so it is compressed; every task writes a file of its own."""

    def comma(column: str):
        return F.replace(F.col(column).cast("string"), F.lit("."), F.lit(","))

    rows = raw_rows(spark, folder)
    text = rows.withColumns(
        {c: comma(c) for c in ("CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT")}
        | {"D_REG": F.date_format("D_REG", "dd.MM.yy")}
    )
    path = scratch_path(spark, "registry-csv")
    write_delimited(text, path, sep=";", compression="gzip")
    return load_registry(spark, path)


def source_inferred_csv(spark, folder):
    path = scratch_path(spark, "part-csv")
    write_delimited(read_table(spark, folder, "part"), path, sep=";")
    return read_delimited(spark, path)


def sink_csv_results(spark, folder):
    """Two results committed side by side and read back."""
    path = scratch_path(spark, "results")
    items = read_table(spark, folder, "lineitem")
    results = {
        "flags": aggregates.count_by(items, ["l_returnflag"]),
        "orders": aggregates.count_by(items, ["l_orderkey"]),
    }
    report = write_results(spark, results, path)
    written = [
        read_delimited(spark, f"{path}/question_{name}", "label string, count bigint", sep=",")
        .withColumn("name", F.lit(name))
        for name in results
    ]
    return written[0].unionByName(written[1]).join(F.broadcast(report.drop("error")), "name")


def sink_error_report(spark, folder):
    """What became of three results, two of which cannot be built, and the rows written."""
    path = scratch_path(spark, "results")
    items = read_table(spark, folder, "lineitem")

    def fails(error):
        raise error

    results = {
        "flags": aggregates.count_by(items, ["l_returnflag"]),
        "state": lambda: fails(RuntimeError("no shared folder")),
        "key": lambda: fails(KeyError("absent")),
    }
    report = write_results(spark, results, path).drop("error")
    written = read_delimited(spark, f"{path}/question_flags", "label string, count bigint", sep=",")
    total = written.agg(F.sum("count").alias("rows")).select(F.lit("flags").alias("name"), "rows")
    return report.join(total, "name", "left")


def sink_manifest(spark, folder):
    """What the manifest says after a run of which one result failed that had been good
    before, and the rows that are there."""
    path = scratch_path(spark, "results")
    items = read_table(spark, folder, "lineitem").select("l_returnflag", "l_quantity")

    def results(**changed):
        return {"flags": aggregates.count_by(items, ["l_returnflag"]), "items": items} | changed

    write_results(spark, results(), path)
    failing = items.withColumn("l_quantity", F.raise_error(F.lit("broken")).cast("double"))
    write_results(spark, results(flags=aggregates.count_by(items.limit(0), ["l_returnflag"]), items=failing), path)
    there = [
        read_delimited(spark, f"{path}/question_{name}", schema, sep=",").agg(F.count(F.lit(1)).alias("there")).select(
            F.lit(name).alias("name"), "there"
        )
        for name, schema in (("flags", "label string, count bigint"), ("items", "flag string, quantity double"))
    ]
    return read_manifest(spark, path).drop("files").join(there[0].unionByName(there[1]), "name")


def plan_report_q02(spark, folder):
    """The answer of question 2, each row with what the report of its plan shows."""
    answer = QUESTIONS[2](registry(spark, folder))
    report = plan_report(answer)
    shown = {
        "sections": "== Physical Plan ==" in report,
        "scans_nation": "nation.parquet" in report and "ReadSchema" in report,
        "pushed": "PushedFilters: [" in report,
    }
    return answer.select("*", *[F.lit(v).alias(c) for c, v in shown.items()])


# --- parsing -------------------------------------------------------------------------


def parse_dates(spark, folder):
    """Short dates, long dates and text in another format, in turn."""
    styles = [
        F.when(F.col("o_orderkey") % 3 == i, F.date_format("o_orderdate", p))
        for i, p in enumerate(("dd.MM.yy", "d.M.yyyy", "yyyy-MM-dd"))
    ]
    orders = read_table(spark, folder, "orders")
    return parse_short_date(orders.select("o_orderkey", F.coalesce(*styles).alias("day")), "day")


def parse_decimals(spark, folder):
    """Numbers with a decimal comma, some followed by a unit."""
    text = F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    unit = F.when(F.col("l_quantity") == 7, " kg").otherwise(" ")
    items = read_table(spark, folder, "lineitem")
    return parse_decimal(
        items.select("l_orderkey", "l_linenumber", F.concat(text, unit).alias("price")), ["price"]
    )


# --- cleaning ------------------------------------------------------------------------


def standardise_text(spark, folder):
    part = read_table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"), "p_brand", "p_type"
    )
    return cleaning.standardise_text(part, None, (*SENTINELS, "HOT RING", "PROMO"))


def keep_in_range(spark, folder):
    rows = raw_rows(spark, folder, ("MAKE_YEAR", "OPER_CODE", "DEP_CODE", "CAPACITY"))
    return cleaning.keep_in_range(rows, "MAKE_YEAR", 1996, 2000)


def keep_ordered(spark, folder):
    rows = raw_rows(spark, folder, ("BRAND", "MODEL", "OWN_WEIGHT", "TOTAL_WEIGHT"))
    return cleaning.keep_ordered(rows, "OWN_WEIGHT", "TOTAL_WEIGHT")


def drop_uninformative(spark, folder):
    return cleaning.drop_uninformative(raw_rows(spark, folder))


def fill_missing(spark, folder):
    rows = raw_rows(spark, folder, ("COLOR", "KIND", "CAPACITY", "DEP_CODE"))
    return cleaning.fill_missing(rows, {"CAPACITY": 0.0}, "НЕВІДОМЕ")


def require(spark, folder):
    rows = raw_rows(spark, folder, ("COLOR", "KIND", "CAPACITY", "DEP_CODE"))
    return cleaning.require(rows, ("CAPACITY", "COLOR", "ABSENT"))


def dedup_documents(spark, folder):
    return cleaning.dedup(read_table(spark, folder, "documents").select("text", "lang", "source"))


def dedup_wide_documents(spark, folder):
    """Whole texts compared by fingerprint first."""
    return cleaning.dedup_wide(read_table(spark, folder, "documents").select("text", "lang", "source"))


def dedup_without_identity(spark, folder):
    return cleaning.dedup(
        raw_rows(spark, folder, ("OPER_CODE", "BRAND", "MODEL", "MAKE_YEAR", "KIND"))
    )


def add_features(spark, folder):
    rows = raw_rows(spark, folder, ("DEP_CODE", "MAKE_YEAR", "D_REG"))
    return rows.transform(cleaning.add_age, "MAKE_YEAR", AS_OF).transform(cleaning.add_date_parts)


def iqr_filter_events(spark, folder):
    return outliers.iqr_filter(read_table(spark, folder, "events"), ["value"])


def iqr_filter_documents(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return outliers.iqr_filter(documents, ["n_chars"])


def iqr_filter_sequence(spark, folder):
    """Two columns, the second one's quartiles taken after the first one's filter."""
    items = read_table(spark, folder, "lineitem").select("l_orderkey", *MEASURES)
    return outliers.iqr_filter(items, ["l_extendedprice", "l_quantity"], k=0.25)


def iqr_filter_approx(spark, folder):
    return outliers.iqr_filter(read_table(spark, folder, "events"), ["value"], method="approx")


def iqr_limits_approx(spark, folder):
    """The limits of a sketch, one row per column: whether the ranks of both quartiles are
    within twice the error that it promises, and the limits what follows from them."""
    rows = read_table(spark, folder, "events").select("value").unionByName(
        read_table(spark, folder, "documents").select(F.col("n_chars").cast("double").alias("value"))
    )
    q1, q3 = approx_quantiles(rows, {"value": (0.25, 0.75)})["value"]
    n = F.count("value")
    slack = 2 * rank_error() * n + 1

    def within(q, share):
        value = F.col("value")
        return (F.count_if(value < q) <= share * n + slack) & (F.count_if(value <= q) >= share * n - slack)

    (bound,) = outliers.iqr_bounds(rows, ["value"], method="approx")
    near = (F.count_if(F.col("value") > bound.upper) <= slack + F.count_if(F.col("value") > q3 + 2.9 * (q3 - q1)))
    return rows.agg(n.alias("n"), within(q1, 0.25).alias("first"), within(q3, 0.75).alias("third"), near.alias("limit"))


def fold_rare(spark, folder):
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer")
    )
    return labels.fold_rare(orders, "customer")


def _delivered_twice(rows: DataFrame) -> DataFrame:
    """The raw view with the orders of one priority delivered a second time. Rows are
    repeated as they come, so that the joins behind them are done once."""
    twice = F.when(F.col("FUEL") == TERMS.diesel, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("__delivery", F.explode(twice)).drop("__delivery")


def clean_registry(spark, folder):
    rows = _delivered_twice(raw_rows(spark, folder))
    return apply_cleaning(fit_cleaning(rows, VIEW_CLEANING, stage=True))


def clean_registry_by_identity(spark, folder):
    """Copies are recognised by all columns, before the identifying ones are dropped."""
    config = replace(VIEW_CLEANING, dedup_on="identity")
    rows = _delivered_twice(raw_rows(spark, folder))
    return apply_cleaning(fit_cleaning(rows, config, stage=True))


def audit_registry(spark, folder):
    rows = _delivered_twice(raw_rows(spark, folder))
    return audit_cleaning(fit_cleaning(rows, VIEW_CLEANING, stage=True))


# --- a whole run ---------------------------------------------------------------------


def _fitted(rows):
    rows = _delivered_twice(rows)
    return rows, fit_cleaning(rows, VIEW_CLEANING, stage=True)


def run_raw_categories(spark, folder):
    """The source's text columns: listed values, and how many are shown of the others. The
    view is stored, since the source is read once for its profile and once for the fit."""
    profile = profile_run(*_fitted(materialise(raw_rows(spark, folder), "raw")))["raw_categories"]()
    shown = profile.filter("listed")
    others = profile.filter("not listed").groupBy("column", "listed").agg(F.count("value").alias("count"))
    none = F.lit(None)
    return shown.unionByName(
        others.select("column", "listed", none.cast("bigint").alias("n_distinct"), none.cast("string").alias("value"), "count")
    )


def run_standardised_summary(spark, folder):
    rows, fitted = _fitted(raw_rows(spark, folder))
    summary = profile_run(rows, fitted)["standardised_summary"]()
    return _checked_quartiles(fitted.standardised, summary)


def run_kept_correlation(spark, folder):
    return _rounded(profile_run(*_fitted(raw_rows(spark, folder)))["kept_correlation"](), "corr", 8)


def run_kept_histogram(spark, folder):
    return profile_run(*_fitted(raw_rows(spark, folder)))["kept_histogram"]()


def run_kept_missing(spark, folder):
    return profile_run(*_fitted(raw_rows(spark, folder)))["kept_missing"]()


def run_audit(spark, folder):
    """The audit observed while the clean table is written, next to the rows written."""
    _, fitted = _fitted(raw_rows(spark, folder))
    clean, audit = write_audited(fitted, lambda df: materialise(df, "clean"))
    return audit.withColumn("rows_written", F.lit(clean.count()).cast("bigint"))


# --- profiling -----------------------------------------------------------------------


def profile_shape(spark, folder):
    return profiling.profile_shape(read_table(spark, folder, "lineitem"))


def profile_columns(spark, folder):
    """The schema listing joined to the number of missing values."""
    rows = raw_rows(spark, folder)
    listing = profiling.profile_schema(rows).drop("nullable")
    return listing.join(profiling.profile_missing(rows), "column")


def profile_categories(spark, folder):
    documents = read_table(spark, folder, "documents")
    return profiling.profile_categories(documents, ["lang", "source"])


def _checked_categories(df: DataFrame) -> DataFrame:
    """The category profile against the exact distinct counts, one row per column: how
    many values it gives, how many of them are in the column, and whether its distinct
    count is within four standard deviations of the sketch."""
    columns = text_columns(df)
    profile = materialise(profiling.profile_categories(df, columns), "categories-profile")
    shown = profile.groupBy("column", "listed", "n_distinct").agg(F.count(F.lit(1)).alias("n_values"))
    given = profile.select("column", "value").distinct().withColumnsRenamed({"column": "c", "value": "v"})
    # Column by column, so that a task holds the distinct values of one at a time.
    distinct = [
        df.select(F.col(c).alias("value")).distinct().select(F.lit(c).alias("column"), "value") for c in columns
    ]
    values = reduce(DataFrame.unionByName, distinct)
    same = (F.col("column") == F.col("c")) & F.col("value").eqNullSafe(F.col("v"))
    found = (
        values.join(F.broadcast(given), same, "left")  # at most 20 values a column
        .groupBy("column")
        .agg(F.count("value").alias("exact"), F.count("c").alias("n_present"))
        .filter("n_present > 0")
    )
    within = F.col("listed") | (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.2 * F.col("exact"))
    return shown.join(found, "column").select(
        "column", "listed", "exact", "n_values", "n_present", within.alias("within")
    )


def profile_categories_wide(spark, folder):
    return _checked_categories(read_table(spark, folder, "part"))


def profile_categories_documents(spark, folder):
    return _checked_categories(read_table(spark, folder, "documents"))


def profile_categories_registry(spark, folder):
    """The text columns of the view, stored first: the profile and its check read them
    many times, and the joins are done once."""
    rows = raw_rows(spark, folder)
    return _checked_categories(materialise(rows.select(*text_columns(rows)), "raw"))


def profile_numeric(spark, folder):
    items = read_table(spark, folder, "lineitem")
    return _rounded(profiling.profile_numeric(items, MEASURES), "value", 6)


def _checked_quartiles(df: DataFrame, profile: DataFrame) -> DataFrame:
    """A numeric summary with, for quartiles, whether their ranks are right within twice the
    error that a sketch promises (for 99 in 100), instead of their values."""
    fractions = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    records = []
    for r in profile.collect():  # 8 rows a column
        within, value = F.lit(None).cast("boolean"), F.round(F.lit(r.value).cast("double"), 6)
        if r.metric in fractions:
            column, share = F.col(r.column), fractions[r.metric] * F.count(r.column)
            slack = 2 * rank_error() * F.count(r.column) + 1
            within = (F.count_if(column < r.value) <= share + slack) & (F.count_if(column <= r.value) >= share - slack)
            value = F.lit(None).cast("double")
        fields = (F.lit(r.column), F.lit(r.metric), value, within)
        records.append(F.struct(*[f.alias(n) for f, n in zip(fields, ("column", "metric", "value", "within"))]))
    return df.agg(F.array(*records).alias("r")).select(F.inline("r"))


def profile_numeric_approx(spark, folder):
    items = read_table(spark, folder, "lineitem")
    return _checked_quartiles(items, profiling.profile_numeric(items, MEASURES, "approx"))


def profile_table_numeric(spark, folder):
    """The numeric part of the fused profile."""
    items = read_table(spark, folder, "lineitem").select(*MEASURES, "l_returnflag")
    return _checked_quartiles(items, profile_table(items).numeric_summary())


def profile_missing(spark, folder):
    return profiling.profile_missing(raw_rows(spark, folder))


def histogram(spark, folder):
    return distribution.histogram(read_table(spark, folder, "lineitem"), MEASURES)


def density(spark, folder):
    curve = distribution.density(read_table(spark, folder, "lineitem"), MEASURES)
    return _rounded(curve, "density", 9)


def correlation(spark, folder):
    columns = ("MAKE_YEAR", "AGE", "CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT", "REG_YEAR", "REG_MONTH")
    return _rounded(distribution.correlation(clean_rows(spark, folder, columns)), "corr", 8)


# --- grouped operators on other tables -----------------------------------------------


def count_by(spark, folder):
    return aggregates.count_by(read_table(spark, folder, "events"), ["event_type", "user_id"])


def mean_by(spark, folder):
    events = read_table(spark, folder, "events")
    return aggregates.mean_by(events, ["event_type"], "value", "mean_value", 1)


def sum_by(spark, folder):
    items = read_table(spark, folder, "lineitem")
    return aggregates.sum_by(items, ["l_suppkey"], "l_quantity", "total_quantity")


def distinct_by(spark, folder):
    events = read_table(spark, folder, "events")
    return aggregates.distinct_by(events, ["event_type"], "user_id", "users")


def top_groups(spark, folder):
    return ranking.top_groups(read_table(spark, folder, "lineitem"), "l_suppkey", 7)


def top_groups_sketched(spark, folder):
    """Few frequent keys: the sketch's candidates suffice."""
    return ranking.top_groups_sketched(read_table(spark, folder, "lineitem"), "l_suppkey", 7)


def top_groups_unproven(spark, folder):
    """Many keys of about the same frequency: everything is counted."""
    return ranking.top_groups_sketched(read_table(spark, folder, "lineitem"), "l_orderkey", 7, tracked=1024)


def top_rows(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.top_rows(orders, [F.desc_nulls_last("o_totalprice")], 25, ["o_orderkey"])


def leaders_per_group(spark, folder):
    return ranking.leaders_per_group(read_table(spark, folder, "lineitem"), "l_suppkey", "l_linenumber")


def first_per_group(spark, folder):
    orders = read_table(spark, folder, "orders")
    return ranking.first_per_group(
        orders, ["o_custkey"], ["o_orderkey"], "o_orderdate", reduce_first=False
    )


def above_group_mean(spark, folder):
    items = read_table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_quantity")
    return ranking.above_group_mean(items, ["l_suppkey"], "l_quantity", "mean_quantity")


def gap_to_group_min(spark, folder):
    items = read_table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    return ranking.gap_to_group_min(items, ["l_partkey"], "l_quantity", "gap")


def share_within(spark, folder):
    return ranking.share_within(read_table(spark, folder, "events"), "user_id", "event_type")


def running_count(spark, folder):
    days = read_table(spark, folder, "orders").select(
        "o_orderpriority", F.col("o_orderdate").cast("date").alias("day")
    )
    return ranking.running_count(days, "o_orderpriority", "day")


def running_total_rows(spark, folder):
    """An almost unique order, in blocks: line items of a flag by order and line."""
    items = read_table(spark, folder, "lineitem").select(
        "l_returnflag", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line")
    )
    return ranking.running_count(items, "l_returnflag", "line", window_rows=1_000)


_OPERATORS: tuple[Query, ...] = (
    source_parquet,
    source_registry_csv,
    source_inferred_csv,
    sink_csv_results,
    sink_error_report,
    parse_dates,
    parse_decimals,
    standardise_text,
    keep_in_range,
    keep_ordered,
    drop_uninformative,
    fill_missing,
    require,
    dedup_documents,
    dedup_without_identity,
    add_features,
    iqr_filter_events,
    iqr_filter_documents,
    iqr_filter_sequence,
    iqr_filter_approx,
    fold_rare,
    clean_registry,
    clean_registry_by_identity,
    audit_registry,
    profile_shape,
    profile_columns,
    profile_categories,
    profile_categories_wide,
    profile_categories_documents,
    profile_categories_registry,
    profile_numeric,
    profile_numeric_approx,
    profile_missing,
    histogram,
    density,
    correlation,
    count_by,
    mean_by,
    sum_by,
    distinct_by,
    top_groups,
    top_rows,
    leaders_per_group,
    first_per_group,
    above_group_mean,
    gap_to_group_min,
    share_within,
    running_count,
    running_total_rows,
    top_groups_sketched,
    top_groups_unproven,
    dedup_wide_documents,
    iqr_limits_approx,
    profile_table_numeric,
    plan_report_q02,
    sink_manifest,
    run_raw_categories,
    run_standardised_summary,
    run_kept_correlation,
    run_kept_histogram,
    run_kept_missing,
    run_audit,
)


def all_queries() -> dict[str, Query]:
    questions = {f"q{number:02d}": _question(number) for number in QUESTIONS}
    return questions | {query.__name__: query for query in _OPERATORS}
