"""The operators as queries over the test tables, with the columns they promise."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, decontamination, html_extraction, language_model, line_dedup, lm_scoring, pii, quality_rules, sentencepiece, simhash, suffix_dedup, token_alignment, token_counts
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
BYTE_LEVEL = f"{TOKENIZERS}/byte_bpe_50k.json"


# Edits of the token count query: what goes and what takes its place.
EDITS = (
    (r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<email>"),
    (r"(?<![ \t])[ \t]+(?=\n)", ""),
    (r"(?<=[0-9]{4})[0-9]{4,}", ""),
)


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", simhash.hex_digits("fingerprint").alias("fingerprint"), "component_id")


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_extraction.main_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    encoded = sentencepiece.encode(table(spark, folder, "documents"), vocabulary, keep=["doc_id"])
    decoded = sentencepiece.decode(encoded, vocabulary)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), same.alias("round_trip"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = line_dedup.drop_frequent_lines(table(spark, folder, "documents"), min_docs=10, min_chars=1)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    return language_model.classify(table(spark, folder, "documents"), trusted)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and again with its e-mail addresses masked, white space
    at line ends taken away and long numbers shortened to their first four digits."""
    ranks = token_counts.load_ranks(RANKS)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, ranks).withColumnRenamed("n_tokens", "n_before")
    found = counted.withColumn("edits", token_counts.pattern_edits("text", EDITS))
    edited = token_counts.apply_edits(found, ranks)
    return edited.select(
        "doc_id",
        F.col("n_before").alias("n_tokens"),
        F.size("edits").cast("long").alias("n_edits"),
        F.col("n_tokens").alias("n_tokens_edited"),
        "n_encoded",
    )


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents"))
    kinds = F.col("base.kind")
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in pii.BASE_KINDS
    ]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.drop_repeated_substrings(table(spark, folder, "documents"), length=50)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    docs = table(spark, folder, "documents").select("doc_id", "text", (number % 7 == 2).alias("held_out"))
    model = lm_scoring.train(docs.filter("not held_out"))
    scored = lm_scoring.score(docs, model, keep=("doc_id", "held_out"))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.numbers.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    models = token_alignment.Models.load(BYTE_LEVEL, PIECES)
    return token_alignment.align(table(spark, folder, "documents"), models, keep=("doc_id",))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    repaired = conversation_repair.repair(conversation_repair.damage(conversations))
    hashed = conversation_repair.digest(repaired.turns).withColumnRenamed("conv_id", "hashed_id")
    found = repaired.report.withColumnRenamed("conv_id", "found_id")
    every = conversations.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").join(
        hashed, F.col("conv_id").eqNullSafe(F.col("hashed_id")), "left"
    )
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def all_queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
