import datetime

import pytest
from pyspark.sql import functions as F

from regbook.operators import aggregates, ranking

DAY = datetime.date(2025, 1, 1)


def test_leaders_keep_ties(spark, rows):
    data = [("sedan", "a")] * 2 + [("sedan", "b")] * 2 + [("sedan", "c"), ("van", "c")]
    df = spark.createDataFrame(data, "body string, brand string")
    expected = [("sedan", "a", 2, 1), ("sedan", "b", 2, 1), ("van", "c", 1, 1)]
    assert rows(ranking.leaders_per_group(df, "body", "brand")) == expected


def test_top_groups_break_ties_by_key(spark):
    df = spark.createDataFrame([(x,) for x in "bbaaccd"], "k string")
    assert [r[0] for r in ranking.top_groups(df, "k", 2).collect()] == ["a", "b"]


@pytest.mark.parametrize("reduce_first", [True, False])
def test_first_by_smallest_puts_null_first(spark, rows, reduce_first):
    data = [("x", "m1", DAY), ("x", "m2", None), ("x", "m2", DAY), ("y", "m4", DAY), ("y", "m3", DAY)]
    df = spark.createDataFrame(data, "brand string, model string, day date")
    first = ranking.first_per_group(df, ["brand"], ["model"], "day", reduce_first=reduce_first)
    assert rows(first) == [("x", "m2", None), ("y", "m3", DAY)]


@pytest.mark.parametrize("reduce_first", [True, False])
def test_first_by_largest_puts_null_last(spark, rows, reduce_first):
    data = [("x", "m1", 5.0), ("x", "m2", None), ("x", "m0", 5.0), ("y", "m", None)]
    df = spark.createDataFrame(data, "brand string, model string, w double")
    first = ranking.first_per_group(df, ["brand"], ["model"], "w", True, reduce_first)
    assert rows(first) == [("x", "m0", 5.0), ("y", "m", None)]


def test_running_count_starts_with_null(spark, rows):
    df = spark.createDataFrame([("w", 2001), ("w", None), ("w", 2000), ("w", 2001)], "c string, y int")
    expected = [("w", None, 1, 1), ("w", 2000, 1, 2), ("w", 2001, 2, 4)]
    assert rows(ranking.running_count(df, "c", "y")) == expected


def test_share(spark, rows):
    df = spark.createDataFrame([("b", "p")] * 2 + [("b", "d")], "brand string, fuel string")
    expected = [("b", "d", 1, 3, 33.33), ("b", "p", 2, 3, 66.67)]
    assert rows(ranking.share_within(df, "brand", "fuel")) == expected


def test_share_in_a_hot_group_needs_no_window(spark):
    df = spark.range(3000).select((F.col("id") % 3 * (F.col("id") % 30)).alias("g"), F.col("id").alias("item"))
    for limit in (None, 0):
        shares = ranking.share_within(df, "g", "item", 4, limit)
        assert "Window" not in shares._jdf.queryExecution().toString()
        sizes = dict(df.groupBy("g").count().collect())
        assert sizes[0] >= 1000 and shares.count() == 3000
        assert all(r["total"] == sizes[r.g] and r["count"] == 1 for r in shares.collect())


def test_top_rows(spark):
    df = spark.createDataFrame([(1, "b"), (3, "z"), (3, "a"), (None, "n")], "age int, m string")
    top = ranking.top_rows(df, [F.desc_nulls_last("age")], 2, ["m"])
    assert [tuple(r) for r in top.collect()] == [(3, "a"), (3, "z")]


def test_aggregates(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.5), ("a", None), ("b", 2.25)], "k string, v double")
    assert rows(aggregates.count_by(df, ["k"])) == [("a", 3), ("b", 1)]
    assert rows(aggregates.mean_by(df, ["k"], "v", "m", 1)) == [("a", 1.3), ("b", 2.3)]
    assert rows(aggregates.sum_by(df, ["k"], "v", "s")) == [("a", 2.5), ("b", 2.25)]
    assert rows(aggregates.distinct_by(df, ["k"], "v", "n")) == [("a", 2), ("b", 1)]
