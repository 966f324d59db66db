"""Operators on groups of any size: running totals in blocks, sketched top groups, and
duplicates by fingerprint."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regbook.operators import ranking
from regbook.operators.cleaning import dedup, dedup_wide


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, with an almost unique order and null keys."""
    rng = random.Random(2)
    data = [("big", i // 2) for i in range(2000)] + [("big", None)] * 3
    data += [(f"g{rng.randrange(40)}", rng.randrange(100)) for _ in range(3900)]
    data += [(None, i % 7) for i in range(97)]
    return data, spark.createDataFrame(data, "g string, o int").repartition(6)


def expected_totals(data):
    counts = Counter(data)
    out, so_far = [], {}
    for (g, o), n in sorted(counts.items(), key=lambda x: (str(x[0][0]), x[0][1] is not None, x[0][1] or 0)):
        so_far[g] = so_far.get(g, 0) + n
        out.append((g, o, n, so_far[g]))
    return sorted(out, key=str)


@pytest.mark.parametrize("window_rows", [10**6, 0])
@pytest.mark.parametrize("partitions", ["2", "7"])
def test_running_count(spark, skewed, window_rows, partitions):
    data, df = skewed
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = [tuple(r) for r in ranking.running_count(df, "g", "o", window_rows).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(found, key=str) == expected_totals(data)


def test_no_window_over_a_whole_group(spark, skewed):
    found = ranking.running_count(skewed[1], "g", "o", 0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert len(windows) == 1 and "__block" in windows[0]


def test_running_total_of_rows(spark):
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(d) for d in range(50)]
    data = [("a", d, 1.5) for d in days] + [("b", days[3], 2.0), ("b", days[3], 3.0), ("b", None, 1.0)]
    df = spark.createDataFrame(data, "g string, d date, v double")
    found = {(r.g, r.d): r.total for r in ranking.running_total(df, "g", "d", "v", "total").collect()}
    assert found["a", days[-1]] == 75.0 and found["b", days[3]] == 6.0 and found["b", None] == 1.0


def test_running_total_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, o int")
    assert ranking.running_count(empty, "g", "o", -1).count() == 0


@pytest.mark.parametrize("kind", ["string", "bigint", "double"])
def test_top_groups_proven_by_the_sketch(spark, kind):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 10 < 4, F.col("id") % 5).otherwise(F.col("id") + 1000).cast(kind).alias("k")
    ).repartition(5)
    assert ranking.top_groups_sketched(rows, "k", 5, 256).collect() == ranking.top_groups(rows, "k", 5).collect()


def counted_everything(spark, rows, n, tracked):
    """Whether the answer groups all values instead of the proposed ones."""
    plan = ranking.top_groups_sketched(rows, "k", n, tracked)._jdf.queryExecution().optimizedPlan().toString()
    return "Aggregate" in plan


def test_top_groups_without_proof_are_counted(spark):
    flat = spark.range(5000).select((F.col("id") % 2500).alias("k"))
    assert counted_everything(spark, flat, 3, 256)
    assert ranking.top_groups_sketched(flat, "k", 3, 256).collect() == ranking.top_groups(flat, "k", 3).collect()
    heavy = spark.range(5000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 4).otherwise(F.col("id")).alias("k"))
    assert not counted_everything(spark, heavy, 2, 256)
    # Fewer values than asked for cannot be proven to be all.
    assert ranking.top_groups_sketched(heavy.limit(0), "k", 2).count() == 0
    few = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    assert ranking.top_groups_sketched(few, "k", 5).collect() == ranking.top_groups(few, "k", 5).collect()
    days = spark.range(10).select(F.timestamp_seconds("id").alias("k"))
    assert ranking.top_groups_sketched(days, "k", 2).collect() == ranking.top_groups(days, "k", 2).collect()


@pytest.fixture(scope="module")
def wide(spark):
    rng = random.Random(6)
    data = [(i % 50 if i % 3 else None, "x" * rng.randrange(40), rng.choice([None, 1.5])) for i in range(900)]
    return spark.createDataFrame([*data, (None, None, None), (None, None, None)], "`a.b` int, t string, d double").repartition(4)


@pytest.mark.parametrize("bits", [128, 6, 1])
@pytest.mark.parametrize("limit", [None, 0])
def test_dedup_wide(wide, rows, bits, limit):
    assert rows(dedup_wide(wide, limit, bits)) == rows(dedup(wide))


def test_unique_rows_stay_where_they_are(spark, tmp_path):
    spark.range(1000).select("id", F.repeat(F.lit("long"), 50).alias("t")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    plan = dedup_wide(rows)._jdf.queryExecution().executedPlan().toString()
    unique = plan[plan.index("Union") :].split(":- ", 1)[1].split("+- *(", 1)[0]
    assert "LeftAnti" in plan and "Exchange hashpartitioning" not in unique.split("LeftAnti")[0]
    assert dedup_wide(rows.unionAll(rows.limit(10))).count() == 1000
