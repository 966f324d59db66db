"""The shapes the plans must keep."""

import os

import pytest
from pyspark.sql import functions as F

from regbook.operators import aggregates, ranking
from regbook.operators.lookups import with_lookup
from regbook.plans.explain import plan_report
from regbook.plans.questions import QUESTIONS, Registry
from regbook.schema import CLEAN_COLUMNS
from regbook.sources import operation_dim, region_dim


@pytest.fixture(scope="module")
def registry(spark, tmp_path_factory):
    """A stored clean table of some size."""
    path = str(tmp_path_factory.mktemp("clean") / "t")
    numbers = {"MAKE_YEAR", "AGE", "REG_YEAR", "REG_MONTH"}
    doubles = {"CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT"}

    def column(c):
        value = F.pmod(F.hash("id", F.lit(c)), F.lit(50))
        if c == "D_REG":
            return F.date_add(F.lit("2020-01-01"), value).alias(c)
        kind = "int" if c in numbers else "double" if c in doubles else "string"
        return value.cast(kind).alias(c)

    spark.range(20_000).select(*[column(c) for c in CLEAN_COLUMNS]).write.parquet(path)
    return Registry(spark.read.parquet(path), region_dim(spark), operation_dim(spark))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("number", [1, 2, 3, 4, 5, 6, 7, 8])
def test_lookups_are_broadcast_without_shuffling_rows(registry, number):
    text = plan(QUESTIONS[number](registry))
    assert "BroadcastHashJoin" in text and "BuildRight" in text
    assert "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == (0 if number == 3 else 1)


def test_unbounded_lookup_is_not_broadcast(spark, registry):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "100")
        big = registry.clean.select("REG_ADDR_KOATUU", "MODEL")
        assert "SortMergeJoin" in plan(with_lookup(registry.clean, big, "REG_ADDR_KOATUU"))
    finally:
        spark.conf.set(name, before)


def test_leaders_need_no_window(registry):
    text = plan(QUESTIONS[9](registry))
    assert "Window" not in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("number", [10, 16])
def test_leaders_are_limited_before_the_shuffle(registry, number):
    text = plan(QUESTIONS[number](registry))
    assert text.count("WindowGroupLimit") == 2
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("number", [2, 13, 21])
def test_top_k_needs_no_global_sort(registry, number):
    text = plan(QUESTIONS[number](registry))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("number", [11, 14])
def test_row_level_answers_do_not_shuffle_rows(registry, number):
    text = plan(QUESTIONS[number](registry))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "Window" not in text


@pytest.mark.parametrize("number, column", [(3, "FUEL"), (6, "BRAND"), (19, "COLOR"), (24, "TOTAL_WEIGHT")])
def test_filters_reach_the_scan(registry, number, column):
    text = plan(QUESTIONS[number](registry))
    assert column in text[text.index("PushedFilters") :].split("ReadSchema")[0]


def test_only_needed_columns_are_read(registry):
    text = plan(QUESTIONS[23](registry))
    assert "ReadSchema: struct<BRAND:string,CAPACITY:double>" in text


def test_distinct_counts_spread_a_heavy_key(registry):
    text = plan(aggregates.distinct_by(registry.clean, ["BRAND"], "MODEL", "n"))
    assert "hashpartitioning(BRAND" in text and text.count("Exchange hashpartitioning") == 2


def test_running_windows_see_aggregated_rows(registry):
    text = plan(ranking.running_count(registry.clean, "COLOR", "MAKE_YEAR"))
    assert "Window" in text and "ReadSchema: struct<COLOR:string,MAKE_YEAR:int,count:bigint>" in text


def test_plan_report(registry, capsys):
    report = plan_report(QUESTIONS[2](registry))
    assert "== Physical Plan ==" in report and "TakeOrderedAndProject" in report
    assert capsys.readouterr().out == ""
    assert os.linesep in report
