import math
import random

import pytest

from decimal import Decimal

from pyspark.sql import functions as F

from regbook.operators.outliers import iqr_bounds
from regbook.operators.quantiles import (
    GROUPS,
    Sketched,
    approx_quantiles,
    exact_quantiles,
    rank_error,
    sketch_columns,
)

FRACTIONS = [0.0, 0.25, 0.5, 0.99, 1.0]


def order_statistics(values, fractions=FRACTIONS):
    ordered = sorted(values)
    return [ordered[max(1, math.ceil(p * len(ordered))) - 1] for p in fractions]


def datasets():
    rng = random.Random(7)
    return {
        "uniform": [rng.random() for _ in range(3000)],
        "heavy tail": [math.exp(rng.gauss(0, 5)) for _ in range(3000)],
        "one third equal": [5.0] * 1000 + [rng.gauss(5, 3) for _ in range(2000)],
        "few values": [float(rng.randrange(4)) for _ in range(3000)],
        "constant": [2.0] * 3000,
        "infinite": [math.inf] * 900 + [-math.inf] * 900 + [rng.random() for _ in range(900)],
    }


@pytest.mark.parametrize("name", list(datasets()))
@pytest.mark.parametrize("finish_rows, size", [(100_000, 8_192), (200, 64), (10, 40)])
def test_exact_whatever_the_sketch(spark, name, finish_rows, size):
    values = datasets()[name]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    found = exact_quantiles(df, {"v": FRACTIONS}, finish_rows, size)
    assert found["v"] == order_statistics(values)


def test_several_columns_with_gaps(spark):
    data = [(float(i), i if i % 3 else None, math.nan if i % 2 else -i / 4) for i in range(500)]
    df = spark.createDataFrame(data, "a double, b int, c double")
    found = exact_quantiles(df, {"a": [0.5], "b": [0.25, 0.75], "c": [0.1]}, finish_rows=10, size=20)
    assert found["a"] == order_statistics([a for a, _, _ in data], [0.5])
    assert found["b"] == order_statistics([b for _, b, _ in data if b is not None], [0.25, 0.75])
    assert found["c"] == order_statistics([c for _, _, c in data if not math.isnan(c)], [0.1])


def test_empty_column(spark):
    df = spark.createDataFrame([(None,), (math.nan,)], "v double")
    assert exact_quantiles(df, {"v": [0.5, 0.9]}) == {"v": [None, None]}
    assert approx_quantiles(df, {"v": [0.5, 0.9]}) == {"v": [None, None]}


def test_approximate_rank_error(spark):
    values = datasets()["heavy tail"]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    (median,) = approx_quantiles(df, {"v": [0.5]}, size=400)["v"]
    assert abs(sum(v <= median for v in values) / len(values) - 0.5) <= 2 * rank_error(400)


BIG = 2**53


def test_whole_numbers_and_decimals_stay_exact(spark):
    data = [(BIG + i, Decimal(i).scaleb(-2) + 10**15, 2**63 - 1 - i) for i in range(1, 3001)]
    df = spark.createDataFrame(data, "a long, b decimal(20,2), c long").repartition(4)
    for finish_rows in (100_000, 50):
        found = exact_quantiles(df, dict.fromkeys("abc", FRACTIONS), finish_rows, 64)
        for i, c in enumerate("abc"):
            assert found[c] == order_statistics([r[i] for r in data]), c
    assert exact_quantiles(df.filter(f"a = {BIG + 1}"), {"a": [0.5]}) == {"a": [BIG + 1]}


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 4.0)], "`a.b` int, `c``d` double")
    assert exact_quantiles(df, {"a.b": [0.5], "c`d": [1.0]}) == {"a.b": [1], "c`d": [4.0]}


@pytest.mark.parametrize("finish_rows", [100_000, 100])
def test_sketches_of_other_rows_only_cost_passes(spark, finish_rows):
    values = datasets()["heavy tail"]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = [v for v in values if v < 1.0]
    wrong = [sketch_columns(df, ["v"], 64), {"v": Sketched(10**9, [1e9, 2e9, 3e9], 0.01)}]
    for sketched in wrong:
        found = exact_quantiles(df.filter("v < 1"), {"v": FRACTIONS}, finish_rows, 64, sketched)
        assert found["v"] == order_statistics(kept)


def jobs_of(spark, function):
    """Jobs that a call starts."""
    name = f"jobs-{id(function)}"
    spark.sparkContext.setJobGroup(name, name)
    function()
    spark.sparkContext._jsc.clearJobGroup()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_few_jobs_for_several_limits(spark):
    rng = random.Random(1)
    data = [(rng.gauss(50, 9), rng.gauss(9, 2), rng.random()) for _ in range(4000)]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(3).cache()
    df.count()
    sketched, found = sketch_columns(df, ["a"]), []
    first = jobs_of(spark, lambda: sketch_columns(df, ["a"]))
    one = jobs_of(spark, lambda: exact_quantiles(df, {"a": [0.25, 0.75]}, sketched=sketched))
    all_three = jobs_of(spark, lambda: found.append(iqr_bounds(df, ["a", "b", "c"], k=1.5, floor=None)))
    # One pass for the sketches and one for each column.
    assert all_three <= first + 3 * one
    rows = data
    for i, bound in enumerate(found[0]):
        q1, q3 = order_statistics([r[i] for r in rows], [0.25, 0.75])
        assert (bound.lower, bound.upper) == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        rows = [r for r in rows if bound.lower <= r[i] <= bound.upper]


def test_sketches_meet_in_groups_first(spark, capfd):
    df = spark.range(1000).withColumn("v", F.rand(1)).repartition(7)
    grouped = df.groupBy((F.spark_partition_id() % GROUPS).alias("part")).count()
    assert grouped.count() == 7
    found = sketch_columns(df, ["v", "id"])
    assert (found["v"].n, found["id"].n) == (1000, 1000) and found["id"].cuts[0] == 0 and found["id"].cuts[-1] == 999
