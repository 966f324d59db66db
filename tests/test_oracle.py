"""Every registered query against the same question in SQL."""

import os

import pytest

import __spark_entry__ as driver
from oracle import compare, connect
from pyspark.sql import functions as F
from regbook.workload.oracles import all_oracles
from regbook.workload.queries import all_queries
from regbook.workload.view import clean_rows, raw_rows

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_oracles()
ROWS_ONLY = {"iqr_filter_approx"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


def test_only_sketches_lack_an_oracle():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sql, name):
    assert compare(QUERIES[name](spark, FOLDER), sql, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_sketches_return_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 5


def test_driver_has_them():
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_items_without_an_order_or_part_drop_out(spark, tmp_path):
    for name in ("orders", "part", "customer"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    items = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    lost = [items.limit(2).withColumn(key, F.lit(-1).cast("long")) for key in ("l_orderkey", "l_partkey")]
    items.unionByName(lost[0]).unionByName(lost[1]).write.parquet(f"{tmp_path}/lineitem.parquet")
    for column in ("OPER_CODE", "BRAND", "FUEL", "PURPOSE"):
        assert raw_rows(spark, str(tmp_path), [column]).count() == items.count()
        assert clean_rows(spark, str(tmp_path), [column]).columns == [column]
