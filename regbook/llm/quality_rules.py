"""Quality rules by robust multivariate outliers.

Every text gives a few counts. Transformed to shares, they form a vector per document;
per language and source the minimum-covariance-determinant estimate describes what the
bulk of the documents looks like, and a document whose Mahalanobis distance from it is
too large is rejected.

The estimate is found by concentration steps from one robust start (medians and median
absolute deviations): take the ``SUPPORT`` share of rows that are nearest, estimate mean
and covariance from them, measure all rows again. Distances are ranked by counting them
in fine bins, moments are sums, so every step is an aggregate with map-side combine and
a group may hold any share of the rows. Only one row per group is inverted in Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise
from .common import arrow_map

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_short")
SYMBOLS = b"#*$%&|<>"
SUPPORT = 0.75
STEPS = 4
MIN_ROWS = 100
# Spread that a share shows at least; many documents have exactly none of some feature.
FLOOR = 0.02
# Bins per doubling of a squared distance, and per unit of a feature.
FINE = 64
REJECT_P = 1e-9


def _counts(text: bytes | None) -> tuple[int, ...]:
    text = text or b""
    words = text.split()
    if not words:
        return (0,) * len(COUNTS)
    joined = b"".join(words)
    codes = np.frombuffer(joined, np.uint8)
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    upper = int(np.count_nonzero((codes >= 65) & (codes <= 90)))
    chars = int(np.count_nonzero((codes & 0xC0) != 0x80))
    repeated_lines = 0
    if b"\n" in text:
        lines = [line for line in text.split(b"\n") if line.strip()]
        repeated_lines = len(lines) - len(set(lines))
    short = sum(len(w) == 1 for w in words)
    return len(words), chars, symbols, repeated_lines, _repeated_words(words), upper, short


def _repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    # Pairs are numbered first, so that three ids of any size fit one number.
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, inverse, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = times[inverse] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).cast(pa.binary())
        table = np.array([_counts(t.as_py()) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS))
        columns = [pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(COUNTS))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *columns], names=["doc_id", "lang", "source", "text_key", *COUNTS]
        )


def text_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Id, language, source and the counts of each text, one row per row of ``docs``.

    Words are runs without ASCII white space; a null text has none. ``n_upper`` counts
    A-Z, ``n_short`` words of one byte. ``text_key`` is a hash of the text."""
    rows = docs.select(
        F.col(text_col).alias("text"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
    )
    schema = ", ".join(f"{c} long" for c in COUNTS)
    return arrow_map(rows, _count_batches, f"doc_id long, lang string, source string, text_key long, {schema}")


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )


def statistics() -> list[Column]:
    """The statistic vector: shares on a square-root scale and the mean word length."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return [
        F.log2(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_upper") / chars),
        F.sqrt(F.col("n_short") / words),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


DIMENSIONS = 5
FLOORS = (0.05, FLOOR, FLOOR, FLOOR, 0.1)


def _weighted_quantile(binned: DataFrame, group: list[str], share: float) -> DataFrame:
    """The lowest ``bin`` of each group that holds ``share`` of its ``n`` at or below."""
    window = Window.partitionBy(*group)
    placed = binned.withColumns(
        {"below": F.sum("n").over(window.orderBy("bin")), "total": F.sum("n").over(window)}
    )
    return placed.filter(F.col("below") >= F.lit(share) * F.col("total")).groupBy(*group).agg(
        F.min("bin").alias("bin")
    )


def _medians(rows: DataFrame, vector: Column) -> DataFrame:
    """Per group an array with the median of each entry of ``vector``, to 1/1024."""
    long = rows.select("group", F.posexplode(vector).alias("d", "v"))
    binned = long.groupBy("group", "d", F.floor(F.col("v") * 1024).alias("bin")).agg(F.count("*").alias("n"))
    medians = _weighted_quantile(binned, ["group", "d"], 0.5)
    return medians.groupBy("group").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("d", "bin"))), lambda s: (s["bin"] + 0.5) / 1024.0
        ).alias("median")
    )


def _invert_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean and inverse covariance of each group from its moments. The covariance of the
    nearest rows is widened to be consistent for normal data, and its diagonal by the
    floor, so that features without any spread do not make it singular."""
    factor = _consistency(SUPPORT, DIMENSIONS)
    floors = np.diag(np.square(FLOORS))
    for batch in batches:
        means, inverses = [], []
        for n, firsts, seconds in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            mean = np.array(firsts) / n
            square = np.array(seconds).reshape(DIMENSIONS, DIMENSIONS) / n
            cov = factor * (square - np.outer(mean, mean)) + floors
            means.append(mean.tolist())
            inverses.append(np.linalg.inv(cov).ravel().tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(means, pa.list_(pa.float64())), pa.array(inverses, pa.list_(pa.float64()))],
            names=["group", "mean", "inverse"],
        )


def _chi2_quantile(p_upper: float, k: int) -> float:
    """Upper quantile of chi-square, by bisection on its survival function."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_upper(mid, k) > p_upper else (low, mid)
    return high


def _chi2_upper(x: float, k: int) -> float:
    """P(chi-square with ``k`` degrees > x), by recursion over the degrees."""
    if k == 1:
        return math.erfc(math.sqrt(x / 2))
    if k == 2:
        return math.exp(-x / 2)
    half = k / 2 - 1
    return _chi2_upper(x, k - 2) + math.exp(half * math.log(max(x, 1e-300) / 2) - x / 2 - math.lgamma(half + 1))


def _consistency(share: float, k: int) -> float:
    """What the covariance of the nearest ``share`` of normal rows is too small by."""
    return share / (1 - _chi2_upper(_chi2_quantile(1 - share, k), k + 2))


def _estimates(nearest: DataFrame) -> DataFrame:
    """Mean and inverse covariance per group over the given rows."""
    v = F.col("v")
    firsts = [F.sum(v[i]) for i in range(DIMENSIONS)]
    seconds = [F.sum(v[i] * v[j]) for i in range(DIMENSIONS) for j in range(DIMENSIONS)]
    moments = nearest.groupBy("group").agg(
        F.count("*").alias("n"), F.array(*firsts).alias("firsts"), F.array(*seconds).alias("seconds")
    )
    found = arrow_map(moments, _invert_batches, "group string, mean array<double>, inverse array<double>")
    return materialise(found, "estimates")


def _distance() -> Column:
    """The squared Mahalanobis distance of ``v``."""
    off = [F.col("v")[i] - F.col("mean")[i] for i in range(DIMENSIONS)]
    terms = [
        off[i] * off[j] * F.col("inverse")[i * DIMENSIONS + j]
        for i in range(DIMENSIONS)
        for j in range(DIMENSIONS)
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _nearest(measured: DataFrame) -> DataFrame:
    """The ``SUPPORT`` share of each group with the smallest ``d2``, to a bin."""
    bins = F.ceil(F.log2(F.greatest("d2", F.lit(1e-9))) * FINE)
    binned = measured.groupBy("group", bins.alias("bin")).agg(F.count("*").alias("n"))
    limits = _weighted_quantile(binned, ["group"], SUPPORT).withColumnRenamed("bin", "limit")
    limits = materialise(limits, "limits")
    return measured.join(limits, "group").filter(bins <= F.col("limit"))


def covariance_estimates(vectors: DataFrame) -> DataFrame:
    """``(group, mean, inverse)`` for rows ``(group, v)``: the minimum-covariance-
    determinant estimate of each group. Groups of under ``MIN_ROWS`` rows should be
    pooled by the caller."""
    centre = materialise(_medians(vectors, F.col("v")), "centre")
    off = vectors.join(centre, "group").withColumn(
        "off", F.transform("v", lambda x, i: F.abs(x - F.get("median", i)))
    )
    spread = _medians(off.drop("median"), F.col("off")).withColumnRenamed("median", "mad")
    start = centre.join(spread, "group").select(
        "group",
        F.col("median").alias("mean"),
        F.flatten(
            F.transform(
                "mad",
                lambda m, i: F.transform(
                    F.sequence(F.lit(0), F.lit(DIMENSIONS - 1)),
                    lambda j: F.when(
                        j == i, 1 / (F.pow(1.4826 * m, 2) + F.pow(F.get(F.array(*map(F.lit, FLOORS)), i), 2))
                    ).otherwise(0.0),
                ),
            )
        ).alias("inverse"),
    )
    estimates = materialise(start, "estimates")
    for _ in range(STEPS):
        measured = vectors.join(estimates, "group").select("group", "v", _distance().alias("d2"))
        estimates = _estimates(_nearest(measured))
    return estimates


def judge(
    docs: DataFrame,
    reject_p: float = REJECT_P,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Counts of every row of ``docs`` with ``base_failed``, ``distance`` (squared) and
    ``kept``.

    Estimates come from the rows that pass the base rules, per language and source; the
    small sources of a language (under ``MIN_ROWS`` rows) share one. A row is kept if it
    passes the base rules and its squared distance is below the chi-square quantile with
    upper probability ``reject_p``. Null languages and sources count as empty strings; a
    null text has no words and fails. Repeated rows are judged each. Empty tables give
    empty results."""
    counts = materialise(text_counts(docs, id_col, text_col, lang_col, source_col), "counts")
    rows = counts.withColumn("base_failed", base_failed(min_words, max_repeat_percent))
    passed = rows.filter(~F.col("base_failed"))
    sizes = passed.groupBy("lang", "source").count()
    own = F.when(F.col("count") >= MIN_ROWS, F.to_json(F.array("lang", "source")))
    groups = materialise(
        sizes.select("lang", "source", F.coalesce(own, F.to_json(F.array("lang"))).alias("group")), "groups"
    )
    vectors = rows.join(groups, ["lang", "source"], "left").withColumn("v", F.array(*statistics()))
    # The bulk of the documents of a group, without those that fail anyway.
    good = materialise(vectors.filter(~F.col("base_failed")).select("group", "v"), "vectors")
    estimates = covariance_estimates(good)
    limit = _chi2_quantile(reject_p, DIMENSIONS)
    measured = vectors.join(estimates, "group", "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & (F.col("distance") <= limit)
    return measured.select(
        "doc_id", "lang", "source", "text_key", *COUNTS, "base_failed", "distance",
        F.coalesce(kept, F.lit(False)).alias("kept"),
    )


def keep_good(docs: DataFrame, **rules) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, in full. A row is found again by its
    id and text (nulls included), language and source."""
    verdicts = judge(docs, **rules).filter("kept").select("doc_id", "lang", "source", "text_key").distinct()
    renamed = verdicts.withColumnsRenamed({c: f"_{c}" for c in verdicts.columns})
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source")}
    same = (
        (F.xxhash64("text") == F.col("_text_key"))
        & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & (blank["lang"] == F.col("_lang"))
        & (blank["source"] == F.col("_source"))
    )
    return docs.join(renamed, same, "left_semi")
