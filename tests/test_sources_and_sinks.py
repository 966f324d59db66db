import datetime
import glob

import pytest
from pyspark.sql import functions as F

from regbook import storage
from regbook.plans import job
from regbook.schema import RAW_COLUMNS, REGISTRY_SCHEMA
from regbook.sinks import read_manifest, write_delimited, write_results
from regbook.sources import load_registry, read_delimited, read_table

LINE = "P;8000000000;315;o;{day};d;D;ford;{model};{vin};{year};БІЛИЙ;ЛЕГКОВИЙ;b;p;f;{cap};1000,5;1500;n{vin}"


def write_lines(path, lines):
    path.write_text("\n".join([";".join(RAW_COLUMNS), *lines]), encoding="utf-8")
    return str(path)


def test_load_registry(spark, tmp_path):
    path = write_lines(
        tmp_path / "r.csv",
        [
            LINE.format(day="05.01.26", model="a", vin=1, year=2020, cap="1598,5"),
            LINE.format(day="xx", model='""', vin=2, year="20x0", cap=""),
        ],
    )
    df = load_registry(spark, path)
    assert df.columns == list(RAW_COLUMNS)
    assert dict(df.dtypes)["D_REG"] == "date" and dict(df.dtypes)["MAKE_YEAR"] == "int"
    first, second = df.orderBy("VIN").collect()
    assert (first.D_REG, first.MAKE_YEAR, first.CAPACITY) == (datetime.date(2026, 1, 5), 2020, 1598.5)
    assert first.OWN_WEIGHT == 1000.5
    assert (second.D_REG, second.MAKE_YEAR, second.CAPACITY, second.MODEL) == (None, None, None, None)


def test_schema_prunes_the_scan(spark, tmp_path):
    path = write_lines(tmp_path / "r.csv", [])
    plan = load_registry(spark, path).select("BRAND")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<BRAND:string>" in plan


def test_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b;c\n1;x;1.5\n2;y;2\n")
    assert read_delimited(spark, str(tmp_path / "t.csv")).dtypes == [
        ("a", "int"), ("b", "string"), ("c", "double"),
    ]


def test_read_table(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert read_table(spark, str(tmp_path), "t").count() == 3


def test_written_text_round_trips(spark, tmp_path, rows):
    data = [(1, 'say "hi"'), (2, "a,b;c"), (3, None), (4, "")]
    df = spark.createDataFrame(data, "n int, s string")
    write_delimited(df.repartition(3), str(tmp_path / "out"), single_file=True)
    assert len(glob.glob(str(tmp_path / "out" / "part-*"))) == 1
    back = read_delimited(spark, str(tmp_path / "out"), "n int, s string", sep=",")
    assert rows(back) == [(1, 'say "hi"'), (2, "a,b;c"), (3, None), (4, None)]


def test_empty_result_has_a_header(spark, tmp_path):
    write_delimited(spark.range(0), str(tmp_path / "out"), single_file=True)
    (part,) = glob.glob(str(tmp_path / "out" / "part-*"))
    assert open(part).read().strip() == "id"


def test_one_failure_does_not_stop_the_others(spark, tmp_path, rows):
    def cannot_build():
        return spark.range(1).select("absent")

    results = {
        1: spark.range(10).repartition(4),
        2: spark.range(1).select(F.raise_error(F.lit("boom")).cast("string")),
        3: cannot_build,
        4: spark.range(10).repartition(4),
    }
    report = write_results(spark, results, str(tmp_path), file_bytes=1_500)
    assert [(r.name, r.status) for r in report.orderBy("name").collect()] == [
        ("1", "written"), ("2", "failed"), ("3", "failed"), ("4", "written"),
    ]
    assert report.filter("error IS NOT NULL").count() == 2
    manifest = {r.name: (r.status, r.rows, r.files) for r in read_manifest(spark, str(tmp_path)).collect()}
    assert manifest["1"][:2] == ("written", 10) and manifest["2"] == ("failed", None, None)
    for name in "14":
        assert len(glob.glob(str(tmp_path / f"question_{name}" / "part-*"))) == manifest[name][2] > 1


def test_a_failing_result_leaves_the_last_good_one(spark, tmp_path):
    write_results(spark, {"x": spark.range(5)}, str(tmp_path))
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("late"))).otherwise(F.col("id")))
    report = write_results(spark, {"x": broken}, str(tmp_path))
    assert [r.status for r in report.collect()] == ["failed"]
    assert read_delimited(spark, str(tmp_path / "question_x"), sep=",").count() == 5
    assert not (tmp_path / "_staging").exists()


def test_small_results_keep_their_order(spark, tmp_path):
    write_results(spark, {"x": spark.range(1000).repartition(4).orderBy(F.desc("id"))}, str(tmp_path))
    back = read_delimited(spark, str(tmp_path / "question_x"), sep=",")
    assert [r[0] for r in back.collect()] == list(range(999, -1, -1))


def test_overwrites(spark, tmp_path):
    for n in (5, 2):
        write_results(spark, {"x": spark.range(n)}, str(tmp_path))
    assert read_delimited(spark, str(tmp_path / "question_x"), sep=",").count() == 2


def test_sorted_result_stays_sorted(spark, tmp_path):
    top = spark.range(100).orderBy(F.desc("id")).limit(5)
    write_delimited(top, str(tmp_path / "out"), single_file=True)
    back = read_delimited(spark, str(tmp_path / "out"), sep=",")
    assert [r[0] for r in back.collect()] == [99, 98, 97, 96, 95]


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        storage.shared_dir(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert storage.shared_dir(Session()) == "hdfs:///shared"


def test_local_session_gets_a_folder_of_its_own():
    class Context:
        master = "local[2]"
        folder = None

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = f"{folder}/id"

    class Session:
        sparkContext = Context()
        conf = {}

    session = Session()
    assert storage.shared_dir(session) == storage.shared_dir(session) == session.sparkContext.folder


def test_materialised_table_is_read_back(spark, rows):
    df = spark.range(5).withColumn("x", F.lit("a"))
    table = storage.materialise(df, "t")
    assert rows(table) == rows(df) and table.dtypes == df.dtypes
    assert table.inputFiles()[0].removeprefix("file://").startswith(storage.shared_dir(spark))


def test_job(spark, tmp_path):
    lines = [
        LINE.format(day=f"{1 + i % 28:02d}.01.26", model=f"m{i % 3}", vin=i, year=2000 + i % 25, cap=1000 + i)
        for i in range(100)
    ]
    report = job.run(spark, write_lines(tmp_path / "r.csv", lines), str(tmp_path / "out"))
    assert {r.status for r in report.collect()} == {"written"} and report.count() == 24 + 8
    audit = read_delimited(spark, str(tmp_path / "out/audit"), sep=",").orderBy("step").collect()
    assert (audit[0].rows_left, audit[-1].rows_left) == (100, 100)
    assert audit[0].rows_left - sum(r.rows_flagged for r in audit if r.rule != "fold") == audit[-1].rows_left
    summary = read_delimited(spark, str(tmp_path / "out/profiles/standardised_summary"), sep=",")
    assert summary.filter("column = 'AGE' and metric = 'count'").first().value == 100
    shape = read_delimited(spark, str(tmp_path / "out/profiles/raw_shape"), sep=",").first()
    assert tuple(shape) == (100, 20)
    assert "== Physical Plan ==" in "\n".join(r.value for r in spark.read.text(str(tmp_path / "out/plan")).collect())
    clean = spark.read.parquet(str(tmp_path / "out" / "clean"))
    assert clean.count() == 100 and len(clean.columns) == 18
    first = read_delimited(spark, str(tmp_path / "out/results/question_1"), sep=",").collect()
    assert [tuple(r) for r in first] == [("м. Київ", 100)]
    assert len(REGISTRY_SCHEMA) == 20
