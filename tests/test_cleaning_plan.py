import datetime
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from regbook.plans.cleaning import (
    Audit,
    CleaningConfig,
    apply_cleaning,
    audit_cleaning,
    clean_registry,
    fit_cleaning,
    write_audited,
)
from regbook.plans.profiles import profile_run
from regbook.schema import CLEAN_COLUMNS, DECIMAL_COLUMNS, RAW_COLUMNS
from regbook.storage import materialise

TYPES = {"D_REG": "date", "MAKE_YEAR": "int"} | dict.fromkeys(DECIMAL_COLUMNS, "double")
SCHEMA = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in RAW_COLUMNS)


def vehicle(i, **changes):
    row = {
        "PERSON": "P", "REG_ADDR_KOATUU": "8000000000", "OPER_CODE": "315", "OPER_NAME": "o",
        "D_REG": datetime.date(2025, 1, 1 + i % 28), "DEP_CODE": "d", "DEP": "D", "BRAND": "ford ",
        "MODEL": f"m{i}", "VIN": f"v{i}", "MAKE_YEAR": 2000 + i % 20, "COLOR": "red", "KIND": "k",
        "BODY": "b", "PURPOSE": "p", "FUEL": "f", "CAPACITY": 1000.0 + i, "OWN_WEIGHT": 1000.0 + i,
        "TOTAL_WEIGHT": 2000.0 + i, "N_REG_NEW": f"n{i}",
    } | changes
    return tuple(row[c] for c in RAW_COLUMNS)


@pytest.fixture(scope="module")
def raw(spark):
    data = [vehicle(i) for i in range(60)]
    data += [
        vehicle(100, MAKE_YEAR=1899),
        vehicle(101, MAKE_YEAR=2027),
        vehicle(102, OWN_WEIGHT=3000.0),
        vehicle(103, CAPACITY=50000.0),
        vehicle(104, CAPACITY=-1.0),
        vehicle(105, CAPACITY=None, COLOR="-", BRAND=None, MAKE_YEAR=None),
        vehicle(106, OWN_WEIGHT=None),
        vehicle(107, BRAND="rare"),
        vehicle(0),
        vehicle(1, VIN="other"),
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("stage", [False, True])
@pytest.mark.parametrize("quantiles", ["exact", "approx"])
def test_clean(raw, stage, quantiles):
    clean = clean_registry(raw, CleaningConfig(quantiles=quantiles), stage)
    assert tuple(clean.columns) == CLEAN_COLUMNS
    found = {r.MODEL: r for r in clean.collect()}
    assert len(found) == clean.count() == 62
    assert {m for m in found if int(m[1:]) >= 100} == {"M105", "M107"}
    gaps = found["M105"]
    assert (gaps.CAPACITY, gaps.COLOR, gaps.BRAND, gaps.AGE) == (0.0, "НЕВІДОМЕ", "НЕВІДОМЕ", None)
    assert found["M107"].BRAND == "ІНШЕ" and found["M1"].BRAND == "FORD"
    assert (found["M3"].AGE, found["M3"].REG_YEAR, found["M3"].REG_MONTH) == (23, 2025, 1)


def test_identity_keeps_alike_vehicles(raw):
    clean = clean_registry(raw, CleaningConfig(dedup_on="identity"))
    assert clean.count() == 63
    assert clean.filter("MODEL = 'M1'").count() == 2


def test_rare_labels_are_counted_before_rows_without_mass_go(raw):
    # Ten rows of the label, one of them without a mass: still not rare.
    extra = raw.filter("MODEL < 'm2'").limit(10).withColumn("BRAND", F.lit("ten"))
    extra = extra.withColumn("VIN", F.concat("VIN", F.lit("x")))
    one = extra.limit(1).withColumn("TOTAL_WEIGHT", F.lit(None).cast("double"))
    rows = raw.unionByName(extra.limit(9)).unionByName(one)
    brands = {r.BRAND for r in clean_registry(rows).select("BRAND").distinct().collect()}
    assert "TEN" in brands


def audit(raw, **changes):
    fitted = fit_cleaning(raw, replace(CleaningConfig(), **changes))
    return [(r.step, r.rule, r.column, r.rows_flagged) for r in audit_cleaning(fitted).orderBy("step").collect()]


def test_audit(raw):
    assert audit(raw) == [
        (1, "range", "MAKE_YEAR", 2),
        (2, "order", "TOTAL_WEIGHT", 1),
        (3, "outlier", "CAPACITY", 2),
        (4, "outlier", "OWN_WEIGHT", 0),
        (5, "outlier", "TOTAL_WEIGHT", 0),
        (6, "duplicate", None, 2),
    ]
    assert audit(raw, dedup_on="identity")[0] == (1, "duplicate", None, 1)


def test_partitioning_does_not_matter(raw, rows):
    once, many = (clean_registry(raw.repartition(n)) for n in (1, 7))
    assert rows(once) == rows(many)


def test_idempotent_without_outlier_step(raw, rows):
    config = CleaningConfig(iqr_columns=(), label_min_count=1)
    clean = clean_registry(raw, config)
    again = clean_registry(clean.drop("AGE", "REG_YEAR", "REG_MONTH"), config).select(*clean.columns)
    assert rows(again) == rows(clean)


def test_optional_columns(spark):
    df = spark.createDataFrame([(" a ",), ("none",), ("A",)], "name string")
    assert sorted(r[0] for r in clean_registry(df).collect()) == ["A", "НЕВІДОМЕ"]
    assert audit_cleaning(fit_cleaning(df)).first().rows_flagged == 1


def test_limits_reach_the_scan(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    fitted = fit_cleaning(spark.read.parquet(str(tmp_path / "raw")))
    plan = apply_cleaning(fitted)._jdf.queryExecution().executedPlan().toString()
    assert "MAKE_YEAR" in plan[plan.index("PushedFilters") :].split("ReadSchema")[0]
    assert "VIN" not in plan.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("dedup_on", ["row", "identity"])
@pytest.mark.parametrize("label_column", ["BRAND", "absent"])
def test_observed_audit_adds_up(raw, dedup_on, label_column, rows):
    config = CleaningConfig(dedup_on=dedup_on, label_column=label_column)
    fitted = fit_cleaning(raw, config, stage=True)
    clean, audit = write_audited(fitted, lambda df: materialise(df, "clean"))
    assert rows(clean) == rows(apply_cleaning(fitted))
    records = audit.orderBy("step").collect()
    assert (records[0].rule, records[0].rows_left) == ("input", fitted.standardised.count())
    left = records[0].rows_left
    for r in records[1:]:
        left -= r.rows_flagged if r.rule != "fold" else 0
        assert r.rows_left == left
    assert left == clean.count()
    flagged = {(r.rule, r.column): r.rows_flagged for r in records}
    expected = {(r.rule, r.column): r.rows_flagged for r in audit_cleaning(fitted).collect()}
    if dedup_on == "identity":
        expected.pop(("duplicate", None))
    assert expected.items() <= flagged.items()
    assert flagged["required", "OWN_WEIGHT,TOTAL_WEIGHT"] == 1
    assert flagged.get(("fold", "BRAND"), 0) == (1 if label_column == "BRAND" else 0)


def test_one_pass_for_table_and_audit(raw):
    audit = Audit(fit_cleaning(raw, stage=True))
    clean = audit.clean()
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") == 3
    clean.write.format("noop").mode("overwrite").save()
    n = audit.records()[-1][-1]
    assert audit.adds_up(audit.records()[0][-1], n) and not audit.adds_up(0, n)


def test_counts_that_do_not_add_up_are_taken_again(raw):
    fitted, tries = fit_cleaning(raw, stage=True), []

    def write(df):
        tries.append(1)
        written = materialise(df, "clean")
        return written if len(tries) == 3 else written.limit(1)

    assert write_audited(fitted, write)[0].count() == 62 and len(tries) == 3
    with pytest.raises(RuntimeError):
        write_audited(fitted, lambda df: materialise(df, "clean").limit(1), tries=1)


def test_profiles_of_a_run(raw):
    fitted = fit_cleaning(raw, stage=True)
    found = profile_run(raw, fitted)
    assert found["raw_shape"]().first() == (70, 20)
    missing = {r.column: r.n_missing for r in found["kept_missing"]().collect()}
    assert missing["COLOR"] == 1 and missing["BRAND"] == 1 and "VIN" not in missing
    listed = {r.value for r in found["raw_categories"]().filter("column = 'BRAND'").collect()}
    assert listed == {"ford ", "rare", None}
    summary = {(r.column, r.metric): r.value for r in found["standardised_summary"]().collect()}
    assert summary["MAKE_YEAR", "min"] == 1899 and summary["AGE", "max"] == 2026 - 1899
    bins = found["kept_histogram"]().filter("column = 'MAKE_YEAR'").collect()
    assert sum(r["count"] for r in bins) == 64 and min(r.lower for r in bins) == 2000
    assert found["kept_correlation"]().filter("x = 'AGE' and y = 'MAKE_YEAR'").first()["corr"] == pytest.approx(-1)
    assert found["kept_density"]().filter("column = 'CAPACITY'").count() == 200
