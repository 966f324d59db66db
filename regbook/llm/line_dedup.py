"""Removal of lines that many documents share, by levelled sorted runs of line hashes.

A run holds line hashes in sorted order, each with the number of documents it was found
in. Documents come in batches. The lines of a batch are merge-anti-joined with the
settled run, the hashes already found often enough, and the counts of the others become
a run of level 0. When a level holds ``FANOUT`` runs they are compacted into one of the
next level; hashes that have reached the limit move to the settled run. A later batch of
documents thus costs its own lines and the runs it meets, not the corpus again.

Batches must not share documents, or a document counts once per batch.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise, scratch_path
from .common import SPACES, blank_null, lower_ascii, quoted, row_key

# Runs of a level that are compacted into one of the next, and batches of a corpus that
# comes as a whole: more, so that later batches meet what earlier ones have settled.
FANOUT = 2
BATCHES = 4
KEY = ["h1", "h2"]


def line_key(line):
    """The line without white space at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1):
    """``(r1, r2, doc, pos, h1, h2)`` per line: the row it stands in, its document, its
    place and the hash of its key. Lines with shorter keys are left out. A row without
    an id is a document of its own, as far as its text differs from others."""
    named = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    r1, r2 = row_key("doc_id", "text")
    rows = named.select(
        r1.alias("r1"),
        r2.alias("r2"),
        F.when(F.col("doc_id").isNull(), r1).otherwise(F.xxhash64(F.lit(0), "doc_id")).alias("doc"),
        F.posexplode(F.split(blank_null("text"), "\n", -1)).alias("pos", "line"),
    ).withColumn("key", line_key(F.col("line")))
    return rows.filter(F.char_length("key") >= min_chars).select(
        "r1",
        "r2",
        "doc",
        "pos",
        F.xxhash64(F.lit(1), "key").alias("h1"),
        F.xxhash64(F.lit(2), "key").alias("h2"),
    )


class LineRuns:
    """The runs in the shared folder: ``add`` a batch of lines, then ask for ``frequent``."""

    def __init__(self, min_docs: int = 10, fanout: int = FANOUT):
        self.min_docs = min_docs
        self.fanout = fanout
        self.settled: DataFrame | None = None
        self.levels: dict[int, list[DataFrame]] = defaultdict(list)

    def _write(self, run: DataFrame, label: str) -> DataFrame:
        return materialise(run.sortWithinPartitions(*KEY), label)

    def add(self, lines: DataFrame) -> None:
        """Count a batch of lines; ``doc`` tells its documents apart."""
        if self.settled is not None:
            lines = lines.join(self.settled.hint("merge"), KEY, "left_anti")
        seen = lines.groupBy(*KEY, "doc").agg(F.lit(1).alias("one"))
        self._place(0, self._write(seen.groupBy(*KEY).agg(F.count("*").alias("docs")), "run-0"))

    def _place(self, level: int, run: DataFrame) -> None:
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            self._compact(level)

    def _compact(self, level: int) -> None:
        runs = self.levels.pop(level)
        merged = reduce(DataFrame.unionByName, runs).groupBy(*KEY).agg(F.sum("docs").alias("docs"))
        merged = self._write(merged, f"run-{level + 1}")
        often = merged.filter(F.col("docs") >= self.min_docs).select(*KEY)
        rest = merged.filter(F.col("docs") < self.min_docs)
        # A hash may have been settled while one of these runs already held it.
        both = often if self.settled is None else often.unionByName(self.settled).distinct()
        self.settled = self._write(both, "settled")
        self._place(level + 1, rest)

    def frequent(self) -> DataFrame | None:
        """The hashes found in at least ``min_docs`` documents; None before any batch."""
        runs = [run for level in self.levels.values() for run in level]
        found = self.settled
        if runs:
            counts = reduce(DataFrame.unionByName, runs).groupBy(*KEY).agg(F.sum("docs").alias("docs"))
            often = counts.filter(F.col("docs") >= self.min_docs).select(*KEY)
            found = often if found is None else found.unionByName(often).distinct()
        return None if found is None else self._write(found, "frequent")


def drop_frequent_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = BATCHES,
    id_col: str = "doc_id",
    text_col: str = "text",
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with the lines found in at least ``min_docs`` documents taken out of
    ``text_col``, and the counts ``n_lines`` (before) and ``n_dropped`` added.

    Lines are split at ``\\n`` and compared by ``line_key``; keys under ``min_chars``
    code points never count. A null text is one empty line and comes back as an empty
    text. Rows that repeat an id are one document when lines are counted, and each of
    them loses its lines. Rows without an id are documents of their own, one for each
    different text. Columns named ``n_lines`` or ``n_dropped`` are replaced."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    lines = lines_of(docs, id_col, text_col, min_chars)
    lines.withColumn("batch", F.pmod("doc", F.lit(batches))).write.partitionBy("batch").parquet(path)
    schema = "r1 long, r2 long, doc long, pos int, h1 long, h2 long, batch int"
    lines = spark.read.schema(schema).parquet(path)
    runs = LineRuns(min_docs, fanout)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch).select(*KEY, "doc"))
    dropped = (
        lines.join(runs.frequent(), KEY, "left_semi")
        .groupBy("r1", "r2")
        .agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
    )
    r1, r2 = row_key("_id", "_text")
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # The other columns travel in a struct, where no name can clash with one of ours.
    carried = F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)])
    rows = docs.select(carried.alias("_kept"), quoted(id_col).alias("_id"), quoted(text_col).alias("_text"))
    rows = rows.withColumns({"_r1": r1, "_r2": r2}).join(
        dropped.withColumnsRenamed({"r1": "_r1", "r2": "_r2", "dropped": "_dropped"}), ["_r1", "_r2"], "left"
    )
    split = F.split(blank_null("_text"), "\n", -1)
    # One entry per line, so that each line finds its own in constant time.
    ends = F.transform(
        F.array_union(F.col("_dropped"), F.array(F.size(split))),
        lambda at, i: F.when(i == 0, at).otherwise(at - F.get("_dropped", i - 1) - 1),
    )
    flags = F.flatten(
        F.transform(ends, lambda n: F.concat(F.array_repeat(F.lit(True), n), F.array(F.lit(False))))
    )
    lines_left = F.filter(split, lambda line, i: F.get(F.col("_flags"), i))
    rows = rows.withColumn("_flags", F.when(F.col("_dropped").isNotNull(), flags))
    text = F.when(F.col("_dropped").isNull(), blank_null("_text")).otherwise(F.array_join(lines_left, "\n"))
    return rows.select(
        *[text.alias(c) if c == text_col else F.col(f"_kept.c{i}").alias(c) for i, c in enumerate(kept)],
        F.size(split).cast("long").alias("n_lines"),
        F.when(F.col("_dropped").isNull(), 0).otherwise(F.size("_dropped")).cast("long").alias("n_dropped"),
    )
