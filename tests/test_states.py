"""The fused profile against the separate ones."""

import math

import pytest
from pyspark.sql import functions as F

from regbook.operators import profiling
from regbook.operators.distribution import extents
from regbook.operators.states import profile_states, profile_table


@pytest.fixture(scope="module")
def mixed(spark):
    data = []
    for i in range(2000):
        data.append(
            (
                i, 2**53 + i, math.nan if i % 7 == 0 else i / 3, None if i % 5 else float(i % 4),
                f"v{i % 20}", None if i % 3 == 0 else f"w{i % 19}", f"id{i}", f"u{i % 21}", None,
            )
        )
    return spark.createDataFrame(
        data, "a int, b long, `c.c` double, d double, twenty string, nulls string, id string, `t.o` string, none string"
    ).repartition(5)


@pytest.fixture(scope="module")
def profile(mixed):
    return profile_table(mixed)


def test_shape_and_missing(mixed, profile, rows):
    assert rows(profile.shape()) == [(2000, 9)]
    assert rows(profile.missing()) == rows(profiling.profile_missing(mixed))


def test_numeric_summary(mixed, profile):
    expected = {(r[0], r[1]): r[2] for r in profiling.profile_numeric(mixed).collect()}
    found = {(r[0], r[1]): r[2] for r in profile.numeric_summary().collect()}
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        if key[1].endswith("%"):
            assert found[key] == pytest.approx(value, rel=0.01, abs=1)
        else:
            # Doubles near 2 ** 53 are two apart.
            assert found[key] == pytest.approx(value, rel=1e-3 if key[0] == "b" else 1e-12)


def test_extents(mixed, profile):
    found, expected = profile.extents(), extents(mixed, ["a", "b", "c.c", "d"])
    assert found.keys() == expected.keys()
    for c, e in expected.items():
        assert (found[c].n, found[c].low, found[c].high) == (e.n, e.low, e.high)
        assert found[c].spread == pytest.approx(e.spread, rel=1e-3 if c == "b" else 1e-9)


def test_categories(mixed, profile):
    found, expected = {}, {}
    for target, df in ((found, profile.categories()), (expected, profiling.profile_categories(mixed))):
        for r in df.collect():
            target.setdefault(r["column"], []).append((r["listed"], r["n_distinct"], r["value"], r["count"]))
    assert found.keys() | {"none"} == expected.keys() | {"none"}
    for c in ("twenty", "nulls"):
        assert sorted(found[c], key=str) == sorted(expected[c], key=str)
    assert found["none"] == [(True, 1, None, 2000)]
    for c, n in (("id", 2000), ("t.o", 21)):
        assert len({v for _, _, v, _ in found[c]}) == 5 and not any(r[0] for r in found[c])
        assert found[c][0][1] == pytest.approx(n, rel=0.07)


@pytest.mark.parametrize("distinct", [20, 21, 39, 41, 90, 1000])
def test_listed_up_to_the_limit(spark, distinct):
    df = spark.range(4000).select(F.concat(F.lit("v"), F.col("id") % distinct).alias("c")).repartition(3)
    got = profile_table(df).categories().collect()
    assert got[0]["listed"] == (distinct <= 20) and len(got) == (20 if distinct <= 20 else 5)
    if distinct <= 20:
        assert {r["count"] for r in got} == {200}


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(3000).select(F.concat(F.lit("x"), "id").alias("c"))
    one, other = (sorted(r["value"] for r in profile_table(df.repartition(n)).categories().collect()) for n in (1, 7))
    assert one == other


def test_empty_table(mixed):
    profile = profile_table(mixed.limit(0))
    assert profile.shape().collect() == [(0, 9)]
    assert profile.extents() == {} and profile.categories().count() == 0
    assert {r.n_missing for r in profile.missing().collect()} == {0}
    assert {(r.metric, r.value) for r in profile.numeric_summary().collect()} == {
        ("count", 0.0), *((m, None) for m in ("mean", "stddev", "min", "25%", "50%", "75%", "max"))
    }


def test_one_scan(spark, tmp_path):
    spark.range(100).select("id", F.lit("x").alias("t")).write.parquet(str(tmp_path / "t"))
    states = profile_states(spark.read.parquet(str(tmp_path / "t")))
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Expand" not in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
