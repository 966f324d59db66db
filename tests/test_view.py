"""What the queries over the view read, join and store."""

import os
import re
from glob import glob

import pytest
from pyspark.sql import functions as F

from regbook.plans.cleaning import CleaningConfig, fit_cleaning
from regbook.schema import UNINFORMATIVE
from regbook.workload import queries
from regbook.workload.view import TERMS, raw_rows

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_joins_carry_numbers_and_not_the_text_made_of_them(spark):
    plan = optimized(raw_rows(spark, FOLDER))
    joins = plan[plan.index("Join ") :]
    for column in ("VIN", "N_REG_NEW", "DEP_CODE", "OPER_CODE", "REG_ADDR_KOATUU"):
        assert f"AS {column}#" in plan and f"{column}#" not in joins


def test_a_second_delivery_costs_no_second_join(spark):
    plan = optimized(queries._delivered_twice(raw_rows(spark, FOLDER)))
    assert plan.count("Join ") == 3


def test_a_second_delivery_repeats_the_rows_of_one_priority(spark, rows):
    given = [(1, TERMS.diesel), (2, None), (3, "other"), (1, TERMS.diesel)]
    df = spark.createDataFrame(given, "id int, FUEL string")
    found = queries._delivered_twice(df)
    assert found.columns == df.columns
    assert rows(found) == rows(df.unionByName(df.filter(F.col("FUEL") == TERMS.diesel)))


def test_category_profile_of_the_view_joins_once_and_counts_column_by_column(spark, monkeypatch):
    read = []
    inner = queries._checked_categories
    monkeypatch.setattr(queries, "_checked_categories", lambda df: read.append(df) or inner(df))
    found = queries.profile_categories_registry(spark, FOLDER)
    assert "Join " not in optimized(read[0])
    assert "Expand" not in optimized(found) and "lineitem" not in found._jdf.queryExecution().executedPlan().toString()


def test_checked_categories_count_missing_values_and_wide_columns(spark, rows):
    values = [(None if i % 4 == 0 else str(i % 4), f"v{i}", None) for i in range(400)]
    df = spark.createDataFrame(values, "few string, many string, none string")
    found = {r["column"]: tuple(r)[1:] for r in queries._checked_categories(df).collect()}
    assert found["few"] == (True, 3, 4, 4, True)
    assert found["none"] == (True, 0, 1, 1, True)
    assert found["many"] == (False, 400, 5, 5, True)


def test_raw_categories_read_a_stored_source(spark, monkeypatch):
    sources = []
    inner = queries.profile_run
    monkeypatch.setattr(queries, "profile_run", lambda rows, fitted: sources.append((rows, fitted)) or inner(rows, fitted))
    queries.run_raw_categories(spark, FOLDER)
    ((source, fitted),) = sources
    assert "Join " not in optimized(source) and "Join " not in optimized(fitted.source)


def test_identity_compares_no_features(spark, rows):
    days = [("a", "x", 2000, "2001-02-03"), ("a ", "x", 2000, "2001-02-03"), ("b", None, None, None), ("b", None, None, None)]
    df = spark.createDataFrame(days, "BRAND string, VIN string, MAKE_YEAR int, D_REG string").withColumn(
        "D_REG", F.to_date("D_REG")
    )
    config = CleaningConfig(dedup_on="identity", as_of=2001, iqr_columns=(), label_column="ABSENT")
    fitted = fit_cleaning(df, config)
    keys = re.search(r"Aggregate \[([^\]]*)\]", optimized(fitted.standardised)).group(1)
    assert not re.search("AGE|REG_YEAR|REG_MONTH", keys)
    assert fitted.standardised.columns == [c for c in fitted.source.columns if c not in UNINFORMATIVE]
    assert rows(fitted.standardised.drop("D_REG")) == [("A", 2000, 1, 2001, 2), ("B", None, None, None, None)]


def test_identity_keeps_features_that_the_source_names_itself(spark, rows):
    df = spark.createDataFrame([("a", 2000, 7), ("a", 2000, 8)], "BRAND string, MAKE_YEAR int, AGE int")
    config = CleaningConfig(dedup_on="identity", as_of=2001, iqr_columns=(), label_column="ABSENT")
    assert rows(fit_cleaning(df, config).standardised) == [("A", 2000, 1)]


def test_registry_text_is_stored_compressed(spark):
    loaded = queries.source_registry_csv(spark, FOLDER)
    files = loaded.inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert glob(files[0].removeprefix("file://"))
