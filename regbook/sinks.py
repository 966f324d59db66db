"""Delimited text sinks.

Results are committed: a result is computed into a staging folder, measured there, laid out
in as few files as its size allows, and only then put in the place of the last one. A
result that fails at any step leaves what was there before.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of stored rows that go into one file, which one task writes.
FILE_BYTES = 64 << 20
_ORDER = "__order"


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", single_file: bool = False, compression: str = "none"
) -> None:
    """Overwrite ``path`` with delimited text and a header. ``single_file`` moves the
    finished result rows into one task; the query before that stays parallel. Readers know
    a ``compression`` by the file names; one task reads a compressed file."""
    out = df.repartition(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", True).option("sep", sep)
    writer.option("compression", compression).csv(path)


class Folder:
    """A folder of the file system that a path belongs to, by Spark's own client."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def size(self) -> int:
        return self.system.getContentSummary(self.path).getLength()

    def delete(self) -> None:
        self.system.delete(self.path, True)

    def replace_by(self, other: Folder, aside: Folder) -> None:
        """Put ``other`` here. What was here is put ``aside`` first and comes back if that
        fails, so there is always one whole folder."""
        self.system.mkdirs(self.path.getParent())
        had = self.system.exists(self.path)
        if had and not self.system.rename(self.path, aside.path):
            raise OSError(f"cannot move {self.path}")
        if not self.system.rename(other.path, self.path):
            if had:
                self.system.rename(aside.path, self.path)
            raise OSError(f"cannot move {other.path}")
        if had:
            aside.delete()


def commit_delimited(df: DataFrame, path: str, sep: str = ",", file_bytes: int = FILE_BYTES) -> tuple[int, int]:
    """Write ``df`` to ``path`` in the way described above and return the numbers of rows
    and files. Rows keep their order where they fit in one file."""
    spark = df.sparkSession
    parent, name = path.rstrip("/").rsplit("/", 1)
    staging = f"{parent}/_staging/{name}-{uuid.uuid4().hex}"
    try:
        # Every task stores its rows; only what is stored is moved into few files.
        numbered = df.select("*", F.monotonically_increasing_id().alias(_ORDER))
        numbered.write.parquet(f"{staging}/rows")
        stored = spark.read.schema(numbered.schema).parquet(f"{staging}/rows")
        files = max(1, math.ceil(Folder(spark, f"{staging}/rows").size() / file_bytes))
        out = stored.coalesce(files)
        if files == 1:
            out = out.sortWithinPartitions(_ORDER)
        write_delimited(out.drop(_ORDER), f"{staging}/text", sep)
        rows = stored.count()
        Folder(spark, path).replace_by(Folder(spark, f"{staging}/text"), Folder(spark, f"{staging}/before"))
    finally:
        Folder(spark, staging).delete()
    return rows, files


def write_results(
    spark: SparkSession,
    results: Mapping[object, DataFrame | Callable[[], DataFrame]],
    base_path: str,
    prefix: str = "question_",
    parallel: int = 4,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Commit every result to ``<base_path>/<prefix><name>``. A result may be a function
    that builds it; one that fails to build or to write is reported, keeps its last good
    rows, and the others still run. ``parallel`` results are written at a time, since many
    of them leave most of a cluster idle. ``<base_path>/_manifest`` says for each result how
    many rows and files this run committed. Returns (name, status, error)."""

    def write(name: object) -> tuple[str, str, str | None, int | None, int | None]:
        try:
            result = results[name]
            df = result() if callable(result) else result
            rows, files = commit_delimited(df, f"{base_path}/{prefix}{name}", file_bytes=file_bytes)
        except Exception as error:  # any fault of one result must not cost the others
            return str(name), "failed", str(error) or type(error).__name__, None, None
        return str(name), "written", None, rows, files

    with ThreadPoolExecutor(parallel) as pool:
        report = list(pool.map(write, results))
    report = spark.createDataFrame(report, "name string, status string, error string, rows bigint, files int")
    commit_delimited(report.drop("error").coalesce(1), f"{base_path}/_manifest")
    Folder(spark, f"{base_path}/_staging").delete()
    return report.select("name", "status", "error")


def read_manifest(spark: SparkSession, base_path: str) -> DataFrame:
    """(name, status, rows, files) of the last run of ``write_results``."""
    reader = spark.read.option("header", True).schema("name string, status string, rows bigint, files int")
    return reader.csv(f"{base_path}/_manifest")
