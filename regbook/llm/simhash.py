"""SimHash near-duplicates, linked by pigeonring filtering.

A fingerprint is a ring of ``segments`` equal segments. If two fingerprints differ in at
most ``d`` bits, then from some segment on every chain of ``l`` consecutive segments
differs in at most ``l * d / segments`` bits (the strong form of the pigeonring
principle). The first segments of such a chain have a budget below one bit, so they are
equal: they are the key that fingerprints meet on. The rest of the chain is then checked
length by length, which prunes candidates before the Hamming distance itself.

Only distinct fingerprints are linked. A key that more than ``BUCKET`` of them share is
not expanded into pairs: its members emit the points of the Hamming balls around them,
and those that meet in a point are linked to the smallest one there. Balls of half the
distance meet exactly when the centres are within the distance, and a point belongs to
no more balls than a ball has points, so this is complete and linear in the members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialise
from .common import arrow_map
from .components import connected_components

SEED = 42
SEGMENTS = 8
BUCKET = 32


def _fingerprint(text: bytes | None, shingle: int) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(len(hashes), 64)
    ones = np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        prints = np.array([_fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints.view(np.int64))], names=[batch.schema[0].name, "fingerprint"]
        )


def _fingerprinted(rows: DataFrame, shingle: int) -> DataFrame:
    """The first column of ``rows`` beside the fingerprint of the second."""
    schema = T.StructType([rows.schema[0], T.StructField("fingerprint", T.LongType())])
    return arrow_map(rows, partial(_fingerprint_batches, shingle=shingle), schema)


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint)`` per row, the fingerprint as a signed 64-bit number.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are counted
    with repeats. A text of fewer words is one shingle; one without words (null, empty,
    white space) has fingerprint zero."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _fingerprinted(rows, shingle)


def _budgets(max_bits: int, segments: int) -> list[int]:
    return [length * max_bits // segments for length in range(1, segments + 1)]


def _bucket_keys(prints: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """One row per fingerprint and first segment: the segments that must be equal."""
    width = 64 // segments
    equal = max(1, _budgets(max_bits, segments).count(0))
    ring = F.col("fingerprint")
    keys = []
    for first in range(segments):
        turned = F.shiftrightunsigned(ring, first * width).bitwiseOR(
            F.shiftleft(ring, 64 - first * width) if first else F.lit(0)
        )
        key = turned if equal == segments else turned.bitwiseAND(F.lit((1 << (equal * width)) - 1))
        keys.append(F.struct(F.lit(first).alias("first"), key.alias("key")))
    return prints.select("fingerprint", F.explode(F.array(*keys)).alias("k")).select(
        "fingerprint", "k.first", "k.key"
    )


def _chain_holds(first, difference, max_bits: int, segments: int):
    """Every chain of segments from ``first`` on stays within its budget."""
    width = 64 // segments
    turned = F.expr(
        f"shiftrightunsigned({difference}, cast({first} * {width} as int)) | "
        f"case when {first} = 0 then 0L else shiftleft({difference}, cast(64 - {first} * {width} as int)) end"
    )
    holds = F.lit(True)
    for length, budget in enumerate(_budgets(max_bits, segments), 1):
        chain = turned if length == segments else turned.bitwiseAND(F.lit((1 << (length * width)) - 1))
        holds = holds & (F.bit_count(chain) <= budget)
    return holds


def _pair_links(keys: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """Links within keys of at most ``BUCKET`` members."""
    met = keys.groupBy("first", "key").agg(F.sort_array(F.collect_list("fingerprint")).alias("members"))
    pairs = (
        met.filter(F.size("members") > 1)
        .select("first", "members", F.posexplode("members").alias("i", "a"))
        .select("first", "a", F.explode(F.slice("members", F.col("i") + 2, F.lit(BUCKET))).alias("b"))
        .withColumn("difference", F.col("a").bitwiseXOR(F.col("b")))
    )
    return pairs.filter(
        _chain_holds("first", "difference", max_bits, segments) & (F.bit_count("difference") <= max_bits)
    ).select("a", "b")


def _ball(radius: int) -> list[int]:
    """The differences of at most ``radius`` bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _ball_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints that meet in crowded keys."""
    outer, inner = (max_bits + 1) // 2, max_bits // 2
    masks = F.array(*[F.lit(m) for m in _ball(outer)])
    points = prints.select(
        "fingerprint", F.explode(F.transform(masks, lambda m: F.col("fingerprint").bitwiseXOR(m))).alias("point")
    )
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("point"))) <= inner
    met = points.groupBy("point").agg(
        F.collect_list("fingerprint").alias("members"),
        F.min(F.when(near, F.col("fingerprint"))).alias("b"),
    )
    return (
        met.filter((F.size("members") > 1) & F.col("b").isNotNull())
        .select(F.explode("members").alias("a"), "b")
        .filter("a <> b")
        .distinct()
    )


def links(prints: DataFrame, max_bits: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct ``fingerprint`` values of ``prints``
    exactly as all pairs within ``max_bits`` would."""
    keys = _bucket_keys(prints, max_bits, segments)
    sizes = keys.groupBy("first", "key").count().filter("count > 1")
    shared = materialise(sizes, "simhash-keys")
    crowded = shared.filter(F.col("count") > BUCKET)
    sparse = shared.filter(F.col("count") <= BUCKET)
    cold = _pair_links(keys.join(sparse, ["first", "key"], "left_semi"), max_bits, segments)
    hot = keys.join(crowded, ["first", "key"], "left_semi").select("fingerprint").distinct()
    return cold.unionByName(_ball_links(hot, max_bits))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    segments: int = SEGMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, fingerprint, component_id, root)`` per row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the
    smallest id reachable through links. Repeated rows stay repeated. Rows without an id
    keep their null and lend the component none, so a component of such rows alone has a
    null ``component_id``. ``root`` is a fingerprint that names the component. Other
    columns are not read; no rows give no rows."""
    found = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    prints = materialise(
        found.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "prints"
    )
    roots = connected_components(links(prints.select("fingerprint"), max_bits, segments))
    rooted = materialise(
        prints.join(roots, prints.fingerprint == roots.node, "left").select(
            "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
        ),
        "rooted",
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialise(
        rooted.join(least, "root").select("fingerprint", "component_id", "root"), "components"
    )
    return found.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id", "root")


def hex_digits(column: str):
    """A 64-bit number as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Rows that repeat an id are one document: of those, the row that comes first by text
    and then by its other columns stays. A group whose rows all lack an id keeps one of
    them in the same way. All columns of ``docs`` are returned."""
    found = near_duplicates(docs, shingle, max_bits)
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = materialise(
        first.groupBy("root").agg(F.count("*").alias("rows"), F.min("doc_id").alias("doc_id")), "kept"
    )
    alone = (F.col("rows") == 1) & F.col("doc_id").isNotNull()
    kept = docs.join(keep.filter(alone).select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    repeated = keep.filter(~alone).select("root", F.col("doc_id").alias("first_id"))
    if repeated.isEmpty():
        return kept
    some = repeated.select("first_id").distinct()
    rows = docs.join(some, docs.doc_id.eqNullSafe(some.first_id), "left_semi")
    rows = _fingerprinted(rows.select(F.struct(*docs.columns).alias("row"), "text"), shingle)
    roots = found.select("fingerprint", "root").distinct()
    once = (
        rows.join(roots, "fingerprint")
        .join(repeated, "root")
        .filter(F.col("row.doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("root")
        .agg(F.min_by("row", F.struct("row.text", F.to_json("row"))).alias("row"))
    )
    return kept.unionByName(once.select("row.*"))
