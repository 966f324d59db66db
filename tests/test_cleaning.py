import datetime
import math

import pytest

from regbook.operators import cleaning
from regbook.operators.labels import fold_rare
from regbook.operators.outliers import iqr_bounds, iqr_filter
from regbook.schema import SENTINELS


def test_standardise_text(spark, rows):
    texts = ["Ford ", "  ford", "\tford", None, "Null", " none ", "невідомо", "Не визначено"]
    texts += [f" {s.lower()} " for s in SENTINELS]
    df = spark.createDataFrame([(t, 1) for t in texts], "name string, n int")
    cleaned = [r[0] for r in cleaning.standardise_text(df).collect()]
    assert cleaned[:3] == ["FORD", "FORD", "\tFORD"]
    assert set(cleaned[3:]) == {None}


def test_standardise_only_named_columns(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert tuple(cleaning.standardise_text(df, ["x"]).first()) == ("A", "b")


def test_keep_in_range(spark, rows):
    df = spark.createDataFrame([(1899,), (1900,), (2026,), (2027,), (None,)], "y int")
    assert rows(cleaning.keep_in_range(df, "y", 1900, 2026)) == [(None,), (1900,), (2026,)]
    assert rows(cleaning.keep_in_range(df, "y", 1900, 2026, keep_null=False)) == [(1900,), (2026,)]


def test_keep_ordered(spark, rows):
    df = spark.createDataFrame([(1, 2), (2, 2), (3, 2), (None, 1), (1, None)], "a int, b int")
    assert rows(cleaning.keep_ordered(df, "a", "b")) == [(None, 1), (1, None), (1, 2), (2, 2)]


def test_drop_ignores_absent_columns(spark):
    df = spark.createDataFrame([("v", 1)], "VIN string, n int")
    assert cleaning.drop_uninformative(df).columns == ["n"]


def test_fills(spark):
    df = spark.createDataFrame(
        [(None, None, None), (math.nan, "x", None)], "CAPACITY double, name string, n int"
    )
    filled = cleaning.fill_missing(df, {"CAPACITY": 0.0, "ABSENT": 1.0}, "?")
    assert [tuple(r) for r in filled.collect()] == [(0.0, "?", None), (0.0, "x", None)]


def test_require(spark, rows):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (1.0, math.nan)], "a double, b double")
    assert rows(cleaning.require(df, ["a", "b"])) == [(1.0, 1.0)]
    assert cleaning.require(df, ["a", "absent"]).count() == 2
    assert cleaning.require(df, ["absent"]).count() == 3


def test_dedup_counts_null_and_nan_as_equal(spark):
    df = spark.createDataFrame([(None, math.nan)] * 3 + [("a", 1.0)], "k string, v double")
    assert cleaning.dedup(df).count() == 2


def test_features(spark):
    df = spark.createDataFrame(
        [(2020, datetime.date(2025, 3, 9)), (None, None)], "MAKE_YEAR int, D_REG date"
    )
    out = cleaning.add_date_parts(cleaning.add_age(df))
    assert [tuple(r)[2:] for r in out.collect()] == [(6, 2025, 3), (None, None, None)]
    other = spark.createDataFrame([(1,)], "x int")
    assert cleaning.add_date_parts(cleaning.add_age(other)).columns == ["x"]


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_iqr_filter(spark, method):
    values = [float(v) for v in range(1, 101)] + [1000.0, -5.0, math.nan, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = [r[0] for r in iqr_filter(df, ["v"], method=method).collect()]
    assert sorted(v for v in kept if v is not None) == [float(v) for v in range(1, 101)]
    assert kept.count(None) == 1


def test_iqr_without_limits(spark):
    df = spark.createDataFrame([(1.0, None)] * 5 + [(9.0, None)], "flat double, empty double")
    assert iqr_bounds(df, ["flat", "empty", "absent"]) == []
    assert iqr_filter(df, ["flat", "empty"]).count() == 6


def test_iqr_columns_depend_on_earlier_ones(spark):
    # The extreme rows of "a" carry the values that would widen the limits of "b".
    normal = [(float(i % 10), float(i % 10)) for i in range(100)]
    extreme = [(1000.0, 500.0 + i) for i in range(20)]
    df = spark.createDataFrame(normal + extreme, "a double, b double")
    together = iqr_bounds(df, ["a", "b"], k=0.1)
    alone = iqr_bounds(df, ["b"], k=0.1)
    assert [b.column for b in together] == ["a", "b"]
    assert together[1].upper < alone[0].upper


@pytest.mark.parametrize("limit", [None, 0])
def test_fold_rare(spark, limit):
    labels = ["common"] * 10 + ["rare"] * 9 + [None] * 3
    df = spark.createDataFrame([(v, i) for i, v in enumerate(labels)], "brand string, i int")
    counts = dict(fold_rare(df, "brand", limit=limit).groupBy("brand").count().collect())
    assert counts == {"common": 10, "ІНШЕ": 9, None: 3}
