"""Exact substring dedup across documents, by bucket-pointer refinement.

A window is a string of ``length`` bytes. Windows that are equal in two documents are
found as suffixes that share a bucket: every position first gets the bucket of its
``GRAM`` bytes, and buckets are refined with the bucket identifiers of later offsets,
each refinement reusing the one before (1, 2, 4, ... ``GRAM``, then up to ``length``).

Sorting the buckets of every position would shuffle the corpus several times over. The
windows of a text are therefore sorted by the smallest bucket identifier among the
positions inside them: equal windows share it, wherever they stand. Neighbouring windows
mostly have the same one, so a run of them travels as a single row. The steps are

1. every text is cut into such runs; within a batch, runs with equal context are
   resolved at once and only the one of the smallest document goes on; copies of a whole
   text are known by its hash;
2. runs are sorted by bucket, and those whose bucket is in one document only are done;
3. the others fetch their bytes and meet again, now window by window. In a bucket with
   more than ``HOT`` runs the windows themselves are refined to buckets of ``length``
   bytes and sorted by those, so no task has to hold a frequent bucket;
4. covered bytes are merged per document and removed.

No step holds more than a batch, one document or ``HOT`` runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise
from .common import arrow_map
from .hashing import SEEDS, mix, refine

GRAM = 20
HOT = 10_000
# Windows of a run, and positions worked on at once.
RUN = 64
CHUNK = 1 << 21
# Where rows without an id stand in the order of documents: behind all others.
LAST = (1 << 63) - 1


def _letters(data: np.ndarray, seed: int) -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(seed))[data]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def runs(data: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, first start and number of windows of each run of ``data``."""
    found = []
    for first in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[first : first + CHUNK + length - 1]
        least = _smallest(refine(_letters(part, SEEDS[0]), 1, gram), length - gram + 1)
        starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        counts = np.diff(np.append(starts, len(least)))
        if counts.max() > RUN:
            pieces = -(-counts // RUN)
            place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            counts = np.minimum(RUN, np.repeat(counts, pieces) - place * RUN)
            starts = np.repeat(starts, pieces) + place * RUN
        found.append((least[starts], starts + first, counts))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


_odd = 6364136223846793005
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, grown as needed."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_odd, pow(_odd, -1, 1 << 64))):
            row = np.full(size, np.uint64(base))
            row[0] = 1
            _powers[i] = np.cumprod(row)
    return _powers[0], _powers[1]


def _contexts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to its end."""
    powers, inverses = _power(len(data) + 1)
    total = np.concatenate(([np.uint64(0)], np.cumsum(_letters(data, SEEDS[1]) * powers[: len(data)])))
    return mix((total[ends] - total[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def _first_of(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For rows in ``order``, where rows with the same keys begin."""
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    return new


def _covered_before(docs: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Which rows repeat the keys of a row from a smaller document."""
    order = np.lexsort((docs, *keys[::-1]))
    new = _first_of(order, *keys)
    first = docs[order][new][np.cumsum(new) - 1] if len(order) else docs
    out = np.zeros(len(docs), dtype=bool)
    out[order] = docs[order] > first
    return out


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined where they touch or overlap, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _merged_by_row(owner: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """``merge`` for each owner; owners are numbered and in order."""
    out = []
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for numbers, s, e in zip(np.split(owner, cuts), np.split(starts, cuts), np.split(ends, cuts)):
        if len(numbers):
            s, e = merge(s, e)
            out.append((np.full(len(s), numbers[0]), s, e))
    if not out:
        return owner, starts, ends
    return tuple(np.concatenate(x) for x in zip(*out))


# Runs travel as their bucket, document and place; ``at`` packs the place into one number,
# or, below zero, bytes to remove.
RUNS = "k1 long, doc long, row long, at long"
MET = "k1 long, k2 long, doc long, row long, at long, context binary"


def _placed(starts: np.ndarray, counts: np.ndarray, hot: np.ndarray | int = 0) -> np.ndarray:
    return starts.astype(np.int64) << 8 | counts.astype(np.int64) << 1 | hot


def _place(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of windows, and whether the bucket is hot."""
    return at >> 8, (at >> 1) & 127, (at & 1).astype(bool)


def _removed(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return -1 - (starts.astype(np.int64) << 31 | ends.astype(np.int64))


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(np.asarray(c).view(np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _removals(docs, rows, owner, starts, ends) -> tuple[np.ndarray, ...]:
    """Bytes to remove as ``k1, doc, row, at``, spread evenly by a key of their own."""
    owner, starts, ends = _merged_by_row(owner, starts, ends)
    key = mix(docs[owner].astype(np.uint64) * np.uint64(SEEDS[0]) + starts.astype(np.uint64))
    return key, docs[owner], rows[owner], _removed(starts, ends)


def _run_batches(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    names = ["k1", "doc", "row", "at"]
    for batch in batches:
        docs, rows = (batch.column(i).to_numpy() for i in (0, 1))
        parts = []
        for i, text in enumerate(batch.column(2).cast(pa.binary())):
            data = np.frombuffer(text.as_py() or b"", np.uint8)
            if len(data) >= length:
                buckets, starts, counts = runs(data, length, gram)
                context = _contexts(data, starts, starts + counts + (length - 1))
                parts.append((np.full(len(starts), i), buckets, context, starts, counts))
        if not parts:
            continue
        owner, buckets, context, starts, counts = (np.concatenate(x) for x in zip(*parts))
        known = _covered_before(docs[owner], buckets, context)
        yield _batch(names, *_removals(docs, rows, owner[known], starts[known], (starts + counts + length - 1)[known]))
        left = ~known
        owner = owner[left]
        yield _batch(names, buckets[left], docs[owner], rows[owner], _placed(starts[left], counts[left]))


def _shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of runs sorted by bucket and document, those whose bucket is in two documents or
    more, marked as hot in a bucket of more than ``HOT`` runs. Removals pass through."""
    names = ["k1", "doc", "row", "at"]
    held = None
    open_hot = None

    def whole(rows: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))
        ends = np.append(starts[1:], rows.shape[1])
        sizes = ends - starts
        shared = np.repeat(rows[1][starts] < rows[1][ends - 1], sizes)
        rows = rows[:, shared]
        rows[3] |= np.repeat(sizes > HOT, sizes)[shared]
        return _batch(names, *rows)

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(4)])
        gone = rows[3] < 0
        if gone.any():
            yield _batch(names, *rows[:, gone])
            rows = rows[:, ~gone]
        if open_hot is not None:
            same = rows[0] == open_hot
            if same.any():
                more = rows[:, same]
                more[3] |= 1
                yield _batch(names, *more)
                rows = rows[:, ~same]
        if not rows.shape[1]:
            continue
        open_hot = None
        if held is not None:
            rows = np.concatenate((held, rows), axis=1)
        last = np.searchsorted(rows[0], rows[0][-1])
        if last:
            yield whole(rows[:, :last])
        held = rows[:, last:]
        if held.shape[1] > HOT and held[1][0] < held[1][-1]:
            yield whole(held)
            open_hot, held = held[0][0], None
    if held is not None:
        yield whole(held)


def _fetch_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Runs with their bytes; the windows of hot buckets by their own buckets. Both are
    resolved within the batch as far as it goes."""
    unpack = zstandard.ZstdDecompressor().decompress
    names = ["k1", "k2", "doc", "row", "at", "context"]
    for batch in batches:
        docs, rows = (batch.column(i).to_numpy() for i in (0, 1))
        lists = batch.column(3)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        bucket, at = (lists.flatten().field(i).to_numpy() for i in range(2))
        starts, counts, hot = _place(at)
        ends = starts + counts + (length - 1)
        texts = [unpack(t.as_py()) for t in batch.column(2)]
        cold = np.flatnonzero(~hot)
        if len(cold):
            own = owner[cold]
            context = [texts[i][s:e] for i, s, e in zip(own.tolist(), starts[cold].tolist(), ends[cold].tolist())]
            same = np.array([xxhash.xxh64_intdigest(c) for c in context], dtype=np.uint64)
            known = _covered_before(docs[own], bucket[cold], same)
            key, doc, row, gone = _removals(docs, rows, own[known], starts[cold][known], ends[cold][known])
            yield _batch(names, key, np.zeros(len(key), np.int64), doc, row, gone, pa.nulls(len(key), pa.binary()))
            own, cold = own[~known], cold[~known]
            context = pa.array([c for c, k in zip(context, known.tolist()) if not k], pa.binary())
            yield _batch(names, bucket[cold], np.zeros(len(cold), np.int64), docs[own], rows[own], at[cold], context)
        windows = []
        for i in np.flatnonzero(hot).tolist():
            part = np.frombuffer(texts[owner[i]], np.uint8)[starts[i] : ends[i]]
            refined = [refine(_letters(part, s), 1, length) for s in SEEDS]
            windows.append((np.full(counts[i], owner[i]), *refined, np.arange(starts[i], starts[i] + counts[i])))
        if windows:
            own, k1, k2, start = (np.concatenate(x) for x in zip(*windows))
            known = _covered_before(docs[own], k1, k2)
            key, doc, row, gone = _removals(docs, rows, own[known], start[known], start[known] + length)
            yield _batch(names, key, np.zeros(len(key), np.int64), doc, row, gone, pa.nulls(len(key), pa.binary()))
            left = ~known
            own, start = own[left], start[left]
            yield _batch(
                names, k1[left], k2[left] | np.uint64(1), docs[own], rows[own], _placed(start, np.ones_like(start)),
                pa.nulls(len(own), pa.binary()),
            )


def _resolve_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Bytes to remove, from runs sorted by key and document."""
    key, contexts, windows, first = None, {}, {}, 0
    for batch in batches:
        out = []
        starts, counts, _ = _place(batch.column(4).to_numpy())
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for k1, k2, doc, row, at, context, start, count in zip(*columns, starts.tolist(), counts.tolist()):
            if at < 0:
                out.append((doc, row, (-1 - at) >> 31, (-1 - at) & 0x7FFFFFFF))
                continue
            if (k1, k2) != key:
                key, contexts, windows, first = (k1, k2), {}, {}, doc
            if context is None:
                # A window by itself: the key is the window.
                if doc > first:
                    out.append((doc, row, start, start + length))
                continue
            if contexts.setdefault(context, doc) < doc:
                out.append((doc, row, start, start + len(context)))
                continue
            for i in range(count):
                if windows.setdefault(context[i : i + length], doc) < doc:
                    out.append((doc, row, start + i, start + i + length))
        # Only spans that overlap within a run or touch in a document follow each other.
        docs, rows, begin, end = (np.array(x, dtype=np.int64) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 4
        joined = np.zeros(len(docs), dtype=bool)
        joined[1:] = (docs[1:] == docs[:-1]) & (rows[1:] == rows[:-1]) & (begin[1:] == begin[:-1] + 1)
        joined[1:] &= end[1:] == end[:-1] + 1
        heads = np.flatnonzero(~joined)
        tails = np.append(heads[1:] - 1, len(docs) - 1) if len(heads) else heads
        yield _batch(["doc", "row", "at"], docs[heads], rows[heads], _removed(begin[heads], end[tails]))


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary())
        packed = pa.array([pack(t.as_py() or b"") for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=batch.schema.names)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        kept, sizes, removed, spans = [], [], [], []
        for packed, cuts in zip(batch.column(1), batch.column(2)):
            text = unpack(packed.as_py())
            starts, ends = (), ()
            if cuts.is_valid:
                spans_at = -1 - cuts.values.to_numpy()
                starts, ends = (x.tolist() for x in merge(spans_at >> 31, spans_at & 0x7FFFFFFF))
            parts, at = [], 0
            for start, end in zip(starts, ends):
                parts.append(text[at:start])
                at = end
            parts.append(text[at:])
            kept.append(b"".join(parts))
            sizes.append(len(text))
            removed.append(len(text) - len(kept[-1]))
            spans.append(len(starts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.binary())] + [pa.array(x, pa.int64()) for x in (sizes, removed, spans)],
            names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"],
        )


def drop_repeated_substrings(
    docs: DataFrame, length: int = 50, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, kept, n_bytes, n_removed, n_spans)`` per row of ``docs``.

    Texts are UTF-8 bytes. Every byte covered by a string of ``length`` bytes that also
    starts in a document with a smaller id is removed; strings are those of the input.
    ``kept`` holds the remaining bytes, which may split a character.

    A null text is empty; texts under ``length`` bytes stay. Rows that repeat an id are
    one document and remove nothing from each other. Rows without an id are one document
    that comes after all others. Other columns are not read."""
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"),
        F.col(text_col).alias("text"),
    )
    # Rows of one id are told apart by their text; mostly there are none.
    alone = named.groupBy("doc").count().filter("count > 1").isEmpty()
    named = named.withColumn("row", F.lit(0).cast("long") if alone else F.xxhash64("text"))
    texts = named.select("doc", "row", F.col("text").cast("binary").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = arrow_map(texts, partial(_run_batches, length=length, gram=gram), RUNS)
    cut = cut.repartition(parts, "k1").sortWithinPartitions("k1", "doc")
    found = materialise(arrow_map(cut, _shared_batches, RUNS), "shared-runs")
    copies = materialise(_copies(named, length), "copies")
    shared = (
        found.filter("at >= 0")
        .join(copies, ["doc", "row"], "left_anti")
        .groupBy("doc", "row")
        .agg(F.collect_list(F.struct("k1", "at")).alias("runs"))
    )
    packed = arrow_map(texts, _pack_batches, "doc long, row long, text binary")
    fetched = arrow_map(packed.join(shared, ["doc", "row"]), partial(_fetch_batches, length=length), MET)
    met = fetched.repartition(parts, "k1", "k2").sortWithinPartitions("k1", "k2", "doc")
    resolved = arrow_map(met, partial(_resolve_batches, length=length), "doc long, row long, at long")
    whole = copies.select("doc", "row", (-1 - F.col("size")).alias("at"))
    known = found.filter("at < 0").join(copies, ["doc", "row"], "left_anti").select("doc", "row", "at")
    cuts = (
        resolved.unionByName(known)
        .unionByName(whole)
        .groupBy("doc", "row")
        .agg(F.collect_list("at").alias("cuts"))
    )
    packed = arrow_map(
        named.select("doc_id", "doc", "row", F.col("text").cast("binary").alias("text")),
        _pack_batches,
        "doc_id long, doc long, row long, text binary",
    )
    rows = packed.join(cuts, ["doc", "row"], "left").select("doc_id", "text", "cuts")
    return arrow_map(rows, _cut_batches, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def _copies(named: DataFrame, length: int) -> DataFrame:
    """``(doc, row, size)`` of the texts that a smaller document has in full. They go
    as a whole, and their runs need not be compared."""
    size = F.octet_length("text").cast("long")
    keyed = named.filter(size >= length).select(
        "doc",
        "row",
        size.alias("size"),
        F.xxhash64(F.lit(1), "text").alias("t1"),
        F.xxhash64(F.lit(2), "text").alias("t2"),
    )
    first = keyed.groupBy("t1", "t2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    first = materialise(first.filter("first < last").select("t1", "t2", "first"), "copied")
    return keyed.join(first, ["t1", "t2"]).filter("doc > first").select("doc", "row", "size").distinct()
