"""The corpus pipeline: from raw documents to piece numbers.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before
it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regbook.llm import decontamination, line_dedup, quality_rules, sentencepiece, simhash
from regbook.llm.common import table
from regbook.llm.queries import PIECES
from regbook.storage import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays."""
    left = line_dedup.drop_frequent_lines(docs, min_docs=10, min_chars=1)
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs, shingle=3, max_bits=2).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark question, or one asked again, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece numbers of every document, and whether they decode to its text."""
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    encoded = sentencepiece.encode(docs, vocabulary, keep=["doc_id", "lang", "source"])
    checked = sentencepiece.decode(encoded, vocabulary)
    return checked.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding and decoding", pieces),
]

# The stages rest on estimated models, hashes and vocabularies that SQL does not have;
# tests/llm/test_operators.py holds the operators against brute force instead, and
# test_queries.py runs the stages in a row.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{number}")
    return docs
