import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from regbook.operators.groups import broadcast_limit, group_table, with_group_values
from regbook.operators.ranking import above_group_mean, gap_to_group_min


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, NULL keys, and thousands of small groups."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 2500))
        .alias("k"),
        (F.col("id") % 7).cast("int").alias("part"),
        (F.hash("id") % 1000).cast("double").alias("v"),
    )


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("keys", [["k"], ["k", "part"]])
def test_same_as_a_window(skewed, rows, limit, keys):
    by = Window.partitionBy(*keys)
    expected = skewed.withColumn("low", F.min("v").over(by)).withColumn("n", F.count("v").over(by))
    values = {"low": F.min("v"), "n": F.count("v")}
    assert rows(with_group_values(skewed, keys, values, limit)) == rows(expected)


def test_large_tables_are_not_broadcast_whole(skewed):
    groups = group_table(skewed, ["k"], {"low": F.min("v")})
    assert groups.rows == 9000
    assert groups.bytes > 16 * 1500
    plan = groups.attach(skewed, limit=0)._jdf.queryExecution().sparkPlan().toString()
    assert "Union" not in plan and "SortMergeJoin" in plan
    assert groups.table.filter(F.col("__group_rows") > 9).count() <= 1000


def test_rows_are_read_once_and_a_large_group_is_split(spark, tmp_path, rows):
    spark.range(9000).select(
        F.when(F.col("id") % 10 < 3, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id"
    ).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        groups = group_table(df, ["k"], {"n": F.count("id")})
        out = groups.attach(df, limit=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        placed = out.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        found = rows(out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count(f"{tmp_path}/t]") == 1
    assert len(placed) == 8 and max(r["count"] for r in placed) < 2 * 2700 / 8
    by = Window.partitionBy("k")
    assert found == rows(df.withColumn("n", F.count("id").over(by)))


def test_names_with_dots(spark, rows):
    df = spark.createDataFrame([(1, 2), (1, 4)], "`a.b` int, `c.d` int")
    for limit in (None, 0):
        assert rows(with_group_values(df, ["a.b"], {"n": F.max("`c.d`")}, limit)) == [(1, 2, 4), (1, 4, 4)]


def test_unknown_group_gets_null(spark, skewed, rows):
    groups = group_table(skewed, ["k"], {"low": F.min("v")})
    other = spark.createDataFrame([("new",)], "k string")
    assert rows(groups.attach(other)) == [("new", None)]
    assert rows(groups.attach(other, limit=0)) == [("new", None)]


def test_broadcast_limit(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        for text, expected in {"-1": -1, "2048": 2048, "10MB": 10 * 2**20, "1g": 2**30, "1p": 2**50}.items():
            spark.conf.set(name, text)
            assert broadcast_limit(spark) == expected
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("limit", [None, 0])
def test_above_mean_is_strict(spark, rows, limit):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", None)], "k string, v double")
    assert rows(above_group_mean(df, ["k"], "v", "mean", limit)) == [("a", 3.0, 2.0)]


@pytest.mark.parametrize("limit", [None, 0])
def test_gap_keeps_every_row(spark, rows, limit):
    df = spark.createDataFrame([("a", 5), ("a", 2), ("a", 2), (None, 4), ("b", None)], "k string, v int")
    expected = [(None, 4, 0), ("a", 2, 0), ("a", 2, 0), ("a", 5, 3), ("b", None, None)]
    assert rows(gap_to_group_min(df, ["k"], "v", "gap", limit)) == expected


def test_independent_of_partitioning(skewed, rows):
    once = with_group_values(skewed.repartition(1), ["k"], {"n": F.count("v")}, 0)
    many = with_group_values(skewed.repartition(7), ["k"], {"n": F.count("v")}, 0)
    assert rows(once) == rows(many)
