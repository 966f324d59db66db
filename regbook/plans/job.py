"""The batch job: registry text in, clean table and 24 answers out.

    spark-submit --conf spark.checkpoint.dir=<shared folder> \\
        run_registry.py <registry csv> <output folder>
"""

from __future__ import annotations

import sys
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..session import registry_session
from ..sinks import write_delimited, write_results
from ..sources import load_registry, operation_dim, region_dim
from .cleaning import CleaningConfig, fit_cleaning, write_audited
from .explain import plan_report
from .profiles import profile_run
from .questions import QUESTIONS, Registry

# The question whose plan is reported.
EXPLAINED = 2


def run(
    spark: SparkSession,
    source: str | list[str],
    output: str,
    config: CleaningConfig = CleaningConfig(),
) -> DataFrame:
    """Clean the source once, store the clean table as Parquet, and answer every question
    from that table, so each answer reads only its own columns. Files are sorted by the
    columns most questions filter on, which lets scans skip row groups.

    Besides ``clean`` and ``results`` there are ``profiles`` (one folder for each), ``audit``
    (rows removed and changed, step by step, observed while the clean table is written) and
    ``plan`` (the plan of one question as text). Returns the write report of profiles and
    results; a profile that fails costs nothing else."""
    rows = load_registry(spark, source)
    fitted = fit_cleaning(rows, config, stage=True)

    def store(clean: DataFrame) -> DataFrame:
        path = f"{output}/clean"
        clean.sortWithinPartitions("KIND", "FUEL", "BRAND").write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    clean, audit = write_audited(fitted, store)
    write_delimited(audit, f"{output}/audit", single_file=True)
    profiles = write_results(spark, profile_run(rows, fitted), f"{output}/profiles", prefix="")
    registry = Registry(clean, region_dim(spark), operation_dim(spark))
    report = plan_report(QUESTIONS[EXPLAINED](registry))
    spark.createDataFrame([(line,) for line in report.splitlines()], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{output}/plan")
    answers = {number: partial(question, registry) for number, question in QUESTIONS.items()}
    return profiles.unionByName(write_results(spark, answers, f"{output}/results"))


def main() -> None:
    source, output = sys.argv[1:3]
    spark = registry_session("registry-analytics")
    try:
        run(spark, source, output).show(truncate=False)
    finally:
        spark.stop()
