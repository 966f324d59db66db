import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from regbook.operators import distribution, profiling


def test_shape_schema_missing(spark, rows):
    df = spark.createDataFrame([(None, math.nan), ("a", None), ("b", 1.0)], "s string, d double")
    assert rows(profiling.profile_shape(df)) == [(3, 2)]
    assert rows(profiling.profile_schema(df)) == [(1, "s", "string", True), (2, "d", "double", True)]
    assert rows(profiling.profile_missing(df)) == [("d", 2), ("s", 1)]


def categories(df, **options):
    found = {}
    for r in profiling.profile_categories(df, **options).collect():
        listed, n, values = found.setdefault(r.column, (r.listed, r.n_distinct, {}))
        values[r.value] = r["count"]
    return found


def test_categories_at_the_boundary(spark):
    def column(distinct, with_null):
        text = F.concat(F.lit("v"), F.col("id") % distinct)
        return F.when(F.col("id") % 1000 > 0, text) if with_null else text

    df = spark.range(10_000).select(
        column(20, False).alias("twenty"),
        column(19, True).alias("nineteen_and_null"),
        column(20, True).alias("twenty_and_null"),
        column(21, False).alias("twenty_one"),
        F.concat(F.lit("id"), "id").alias("unique"),
        F.lit(None).cast("string").alias("nothing"),
    )
    found = categories(df)
    listed, n, values = found["twenty"]
    assert (listed, n, len(values), sum(values.values())) == (True, 20, 20, 10_000)
    listed, n, values = found["nineteen_and_null"]
    assert (listed, n, values[None], sum(values.values())) == (True, 20, 10, 10_000)
    assert found["nothing"] == (True, 1, {None: 10_000})
    for name, true_distinct in (("twenty_and_null", 20), ("twenty_one", 21), ("unique", 10_000)):
        listed, n, values = found[name]
        assert not listed and len(values) == 5 and set(values.values()) == {None}
        assert abs(n - true_distinct) <= 0.2 * true_distinct
        assert all(df.filter(F.col(name) == v).count() for v in values)


@pytest.mark.parametrize("distinct", [20, 21, 39, 41, 60])
def test_categories_are_listed_up_to_the_limit(spark, distinct):
    df = spark.range(3000).select(F.concat(F.lit("v"), F.col("id") % distinct).alias("a.b"))
    listed, n, values = categories(df)["a.b"]
    assert listed == (distinct <= 20) and len(values) == (20 if listed else 5)
    assert abs(n - distinct) <= 0.2 * distinct
    assert {r.column: r.n_missing for r in profiling.profile_missing(df).collect()} == {"a.b": 0}


def test_infinite_values_have_no_bin(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (math.inf,), (-math.inf,)], "v double")
    assert [r["count"] for r in distribution.histogram(df, bins=2).orderBy("bin").collect()] == [1, 1]
    assert distribution.density(df).count() == 200
    assert distribution.density(df, bandwidth=1e-10).count() == 200


def test_category_sample_does_not_depend_on_partitions(spark):
    df = spark.range(3000).select(F.concat(F.lit("x"), "id").alias("c"))
    assert categories(df.repartition(1)) == categories(df.repartition(7))


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_numeric(spark, method):
    data = [(float(i), i) for i in range(1, 101)] + [(math.nan, None)]
    df = spark.createDataFrame(data, "d double, i int")
    found = {(r.column, r.metric): r.value for r in profiling.profile_numeric(df, None, method).collect()}
    for c in ("d", "i"):
        expected = {"count": 100, "mean": 50.5, "min": 1, "25%": 25, "50%": 50, "75%": 75, "max": 100}
        assert {m: found[c, m] for m in expected} == expected
        assert found[c, "stddev"] == pytest.approx(np.std(range(1, 101), ddof=1))


@pytest.fixture(scope="module")
def measures(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.gamma(2.0, 3.0, 4000), 2)
    y = 0.5 * x + rng.normal(0, 1, 4000)
    data = [(float(a), float(b) if i % 5 else None, (i % 11) / 100) for i, (a, b) in enumerate(zip(x, y))]
    data.append((math.nan, math.nan, None))
    return data, spark.createDataFrame(data, "x double, y double, steps double")


def present(data, i):
    return np.array([r[i] for r in data if r[i] is not None and not math.isnan(r[i])])


@pytest.mark.parametrize("bins", [1, 10, 30])
def test_histogram_as_numpy(measures, bins):
    data, df = measures
    found = {}
    for r in distribution.histogram(df, bins=bins).orderBy("column", "bin").collect():
        found.setdefault(r.column, []).append((r["count"], r.lower, r.upper))
    for i, c in enumerate(df.columns):
        counts, edges = np.histogram(present(data, i), bins=bins)
        assert [n for n, _, _ in found[c]] == counts.tolist()
        assert [low for _, low, _ in found[c]] == pytest.approx(edges[:-1])


def test_histogram_of_constant_and_empty(spark):
    df = spark.createDataFrame([(2.0, None)] * 4, "c double, e double")
    out = distribution.histogram(df, bins=4).collect()
    assert {r.column for r in out} == {"c"}
    assert sum(r["count"] for r in out) == 4 and min(r.lower for r in out) == 1.5
    assert distribution.histogram(df.select("e")).count() == 0
    assert distribution.density(df).count() == 0


def test_density_as_direct_sum(measures):
    data, df = measures
    curve = distribution.density(df, ["x", "y"]).orderBy("column", "point").collect()
    for i, c in enumerate(("x", "y")):
        values = present(data, i)
        h = values.std(ddof=1) * len(values) ** -0.2
        grid = np.linspace(values.min(), values.max(), 200)
        kernels = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2)
        direct = kernels.sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
        found = [r for r in curve if r.column == c]
        assert [r.x for r in found] == pytest.approx(grid)
        assert np.allclose([r.density for r in found], direct, atol=direct.max() * 2e-3)


def test_correlation_is_pairwise_complete(measures):
    data, df = measures
    df = df.withColumn("flat", F.lit(1))
    found = {(r.x, r.y): r["corr"] for r in distribution.correlation(df).collect()}
    assert len(found) == 16
    both = np.array([(r[0], r[1]) for r in data if r[1] is not None and not math.isnan(r[1])])
    assert found["x", "y"] == pytest.approx(np.corrcoef(both.T)[0, 1])
    assert found["y", "x"] == found["x", "y"]
    assert found["x", "x"] == 1.0
    assert found["flat", "flat"] is None and found["x", "flat"] is None


def test_correlation_plan_and_size(spark, tmp_path):
    """Twenty columns: a state per task, no row per pair."""
    rng = np.random.default_rng(5)
    x = rng.normal(1e6, 1, (3000, 20))
    x[:, 3] = 7.1
    x[rng.random((3000, 20)) < 0.1] = np.nan
    names = [f"c.{i}" for i in range(20)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"`{n}` double" for n in names)).repartition(5)
    plan = distribution.correlation(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan.split("MapInArrow")[1]
    found = {(r.x, r.y): r["corr"] for r in distribution.correlation(df).collect()}
    assert len(found) == 400
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if 3 in (i, j):
                assert found[a, b] is None
            else:
                assert found[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_co_moments_merge_in_any_order():
    rng = np.random.default_rng(7)
    x = rng.normal(5, 2, (400, 3))
    x[rng.random((400, 3)) < 0.3] = np.nan
    x[:100, 2] = np.nan
    whole = distribution.CoMoments.of(x)
    for cuts in ([100, 250], [1, 2, 399], [400]):
        merged = distribution.CoMoments(3)
        for part in np.split(x, cuts):
            if len(part):
                merged.add(distribution.CoMoments.of(part))
        for name in ("n", "mean", "square", "product"):
            assert np.allclose(getattr(merged, name), getattr(whole, name))


def test_density_meets_near_points_only(spark):
    """Two far heaps: points between them have density zero and are all there."""
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id") / 1e4).otherwise(1e6 + F.col("id") / 1e4).alias("v"))
    curve = distribution.density(df, bandwidth=1.0).orderBy("point").collect()
    assert len(curve) == 200 and curve[100].density == 0.0 and curve[0].density > 0 and curve[199].density > 0


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1.0, 2), (2.0, 4), (3.0, 7)], "`a.b` double, `c``d` int")
    assert {r.column for r in distribution.histogram(df, bins=3).collect()} == {"a.b", "c`d"}
    assert distribution.density(df).count() == 400
    assert distribution.correlation(df).count() == 4
    assert {r.column for r in profiling.profile_numeric(df).collect()} == {"a.b", "c`d"}
