"""Intermediate tables in the shared folder the cluster names.

A result that several later steps read is written once as Parquet, so a lost
executor costs a re-read and not a re-computation of everything before it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Local sessions may leave it unset;
    a cluster may not, because a machine-local folder is not visible to its executors."""
    context = spark.sparkContext
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="regbook-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/regbook/{label}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, label: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table. ``drop_shuffles``
    takes what was shuffled for that off the disks at once, not when the driver collects
    its garbage."""
    path = scratch_path(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    if drop_shuffles:
        conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
