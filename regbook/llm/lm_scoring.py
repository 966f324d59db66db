"""Language-model scoring with a log-frequency Bloom filter.

Words and pairs of neighbours are counted over all training texts; a count is quantised to
a level on a logarithmic scale, and the filter holds a gram once for every level up to its
own. Asking for levels 1, 2, 3, ... until one is missing gives the level back: never too
low, too high by one with the filter's error rate. A level stands for the mean count of
the grams that have it. A word after another has the probability

    (count of the pair + m * p(word)) / (count of the word before + m),
    p(word) = (count + 1) / (tokens + words + 1)

where ``m`` is the mean number of different followers of a word. A pair cannot be more
frequent than either of its words, so its level is cut at theirs.

Counting: each task sums its grams as sorted 64-bit hashes and deals them to shards by
their first bits; a shard's task adds them up and makes the shard's part of the filter, of
a size that follows from what it holds. Shards are as many as keep each small.

Scoring: while the whole filter and the word counts have at most ``BROADCAST_BYTES``, they
are broadcast and every text is scored where it is. Beyond that distinct texts are dealt to
groups of about ``GROUP_BYTES`` by a hash of their content. A group asks each shard once for
all of its distinct grams that belong there, so no shard is asked more than others; the
answers come back in the order of the questions, which the group finds again from its texts.
Both ways ask the same filter and give the same scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise
from .common import arrow_map, quoted, release, row_key
from .hashing import mix

# Levels: a count of BASE ** q and more has level q + 1.
BASE = 1.5
LEVELS = 100
# Probes of a level, and bits for each: one in 2 ** PROBES wrong answers.
PROBES = 5
BITS = PROBES / math.log(2)
# Text of one shard, about.
SHARD_BYTES = 8 << 20
# Every worker holds a copy of what is broadcast.
BROADCAST_BYTES = 16 << 20
# Grams a task sums up before it hands them on, and texts it remembers to send copies once.
FLUSH = 3_000_000
MEMORY = 200_000
# Text worked on at once; a longer one is worked on alone.
SLICE_BYTES = 4 << 20
# Text of a group that asks together, about, and text a task holds before it deals it out.
GROUP_BYTES = 16 << 20
DEAL_BYTES = 32 << 20
# Questions that a shard answers at once.
QUESTIONS = 1 << 17
SEED = 29
# No word holds a line end, so this is the end of a text, and what stands before it.
END = xxhash.xxh64_intdigest(b"\n", SEED)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
THRESHOLDS = np.array(sorted({math.ceil(BASE**q - 1e-9) for q in range(LEVELS)}), dtype=np.int64)


STEP = np.uint64(0xFF51AFD7ED558CCD)
BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
# The first so many bytes of eight.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
# Words of more bytes are hashed one by one.
LONG = 64


def _word_hashes(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each word, eight bytes of all words at a time. ``data`` has eight bytes
    after the last word."""
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    hashes = mix((eights[starts] & FIRST[np.minimum(lengths, 8)]) + lengths.astype(np.uint64) * GOLDEN)
    done, left = 8, np.flatnonzero(lengths > 8)
    while done < LONG and len(left):
        more = eights[starts[left] + done] & FIRST[np.minimum(lengths[left] - done, 8)]
        hashes[left] = mix(hashes[left] * STEP + more)
        done += 8
        left = left[lengths[left] > done]
    for i in left:
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]], SEED)
    return hashes


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens end to end, each text closed by ``END``, and tokens per text.
    What stands before a token is the one before it, or ``END`` at the start."""
    data = b"\n".join([*texts, bytes(8)]).lower()
    blank = BLANK[np.frombuffer(data, np.uint8)]
    blank[-8:] = True
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[::2], edges[1::2]
    closed = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    sizes = np.diff(np.searchsorted(starts, closed), prepend=0) + 1
    flat = np.full(len(starts) + len(texts), END, dtype=np.uint64)
    words = np.ones(len(flat), dtype=bool)
    words[np.cumsum(sizes) - 1] = False
    flat[words] = _word_hashes(data, starts, ends - starts)
    return flat, sizes


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * STEP + word)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """In order. ``np.unique`` of plain numbers goes through a hash table, which takes longer."""
    hashes = np.sort(hashes)
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))] if len(hashes) else hashes


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def pack(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte by byte: the high bytes are zeros."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    columns = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(columns.T).reshape(-1).view(np.uint64).cumsum(dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    most = int(counts.max(initial=0))
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint32 if most < 1 << 32 else np.uint64).tobytes()


def _unpack_counts(data: bytes, n: int) -> np.ndarray:
    kinds = {1: np.uint8, 4: np.uint32, 8: np.uint64}
    return np.frombuffer(data, kinds[len(data) // n] if n else np.uint8).astype(np.int64)


def _raw(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _slices(batch: pa.RecordBatch, texts: list[bytes]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with about ``SLICE_BYTES`` of text at a time."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE_BYTES:
            yield batch.slice(first, i - first), texts[first:i]
            first, size = i, 0
        size += len(text)
    yield batch.slice(first), texts[first:]


GRAMS = "shard long, pair boolean, hashes binary, counts binary"
GRAMS_TYPE = pa.schema([("shard", pa.int64()), ("pair", pa.bool_()), ("hashes", pa.binary()), ("counts", pa.binary())])


def _shards_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    held = {False: [], True: []}
    size = 0

    def handed_on() -> pa.RecordBatch:
        rows = {name: [] for name in GRAMS_TYPE.names}
        for pair, parts in held.items():
            hashes, counts = _summed(*(np.concatenate(x) for x in zip(*parts)))
            shards = _shards_of(hashes, bits)
            starts = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1])))
            for at, to in zip(starts, [*starts[1:], len(hashes)]):
                for name, value in zip(rows, (int(shards[at]), pair, pack(hashes[at:to]), _pack_counts(counts[at:to]))):
                    rows[name].append(value)
            parts.clear()
        return pa.RecordBatch.from_pydict(rows, schema=GRAMS_TYPE)

    for _, texts in (x for b in batches for x in _slices(b, _raw(b.column(0)))):
        flat, _ = tokens(texts)
        if not len(flat):
            continue
        before = np.concatenate((flat[-1:], flat[:-1]))
        for pair, hashes in ((False, flat), (True, pair_hash(before, flat))):
            found = np.unique(hashes, return_counts=True)
            held[pair].append(found)
            size += len(found[0])
        if size > FLUSH:
            yield handed_on()
            size = 0
    if size:
        yield handed_on()


def _spots(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bit that a probe of each key looks at, of so many."""
    return (((keys >> np.uint64(32)) * sizes) >> np.uint64(32)).astype(np.int64)


def _level_keys(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of each gram at a level, for the first probe, and what the next ones add."""
    keys = mix(hashes + np.uint64(level * int(GOLDEN) % 2**64))
    return keys, mix(keys ^ GOLDEN) | np.uint64(1)


FILTER = (
    "shard long, bits binary, n_bits long, n_tokens long, n_words long, n_pairs long, words binary, word_counts binary, "
    "grams array<long>, totals array<long>"
)


def _shard_row(shard: int, blocks: list[tuple[bool, bytes, bytes]]) -> dict:
    found = {}
    for pair in (False, True):
        own = [(unpack(h), c) for p, h, c in blocks if p == pair]
        hashes = np.concatenate([h for h, _ in own] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([_unpack_counts(c, len(h)) for h, c in own] or [np.zeros(0, np.int64)])
        hashes, counts = _summed(hashes, counts)
        found[pair] = (hashes, counts, np.searchsorted(THRESHOLDS, counts, side="right"))
    entries = sum(int(levels.sum()) for _, _, levels in found.values())
    n_bits = max(64, 8 * math.ceil(entries * BITS / 8))
    flags = np.zeros(n_bits, dtype=bool)
    grams, totals = np.zeros((2, 2 * LEVELS), dtype=np.int64)
    for pair, (hashes, counts, levels) in found.items():
        grams[pair * LEVELS : (pair + 1) * LEVELS] = np.bincount(levels, minlength=LEVELS)[:LEVELS]
        totals[pair * LEVELS : (pair + 1) * LEVELS] = np.bincount(levels, counts, LEVELS)[:LEVELS].astype(np.int64)
        for level in range(1, int(levels.max(initial=0)) + 1):
            keys, steps = _level_keys(hashes[levels >= level], level)
            for _ in range(PROBES):
                flags[_spots(keys, np.uint64(n_bits))] = True
                keys += steps
    words, word_counts, _ = found[False]
    return {
        "shard": shard, "bits": np.packbits(flags, bitorder="little").tobytes(), "n_bits": n_bits,
        "n_tokens": int(word_counts.sum()), "n_words": len(words), "n_pairs": len(found[True][0]),
        "words": words.tobytes(), "word_counts": word_counts.astype(np.uint32 if word_counts.max(initial=0) < 1 << 32 else np.uint64).tobytes(),
        "grams": grams.tolist(), "totals": totals.tolist(),
    }


FILTER_TYPE = pa.schema(
    [
        *[(n, pa.binary() if n in ("bits", "words", "word_counts") else pa.int64()) for n in
          ("shard", "bits", "n_bits", "n_tokens", "n_words", "n_pairs", "words", "word_counts")],
        ("grams", pa.list_(pa.int64())), ("totals", pa.list_(pa.int64())),
    ]
)


def _filter_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams sorted by shard to one row of the filter for each shard."""
    held, shard = [], None
    for batch in batches:
        for own, pair, hashes, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if own != shard and held:
                yield pa.RecordBatch.from_pylist([_shard_row(shard, held)], schema=FILTER_TYPE)
                held = []
            shard = own
            held.append((pair, hashes, counts))
    if held:
        yield pa.RecordBatch.from_pylist([_shard_row(shard, held)], schema=FILTER_TYPE)


@dataclass(frozen=True)
class Numbers:
    """What a score needs besides the filter, of fixed size."""

    bits: int
    n_tokens: int
    n_words: int
    followers: float
    # Mean count by level, of words and of pairs.
    means: np.ndarray


@dataclass(frozen=True)
class Model:
    """The filter as a table of shards, its size in bytes and the numbers for scoring."""

    shards: DataFrame
    size: int
    numbers: Numbers


def train(texts: DataFrame, text_col: str = "text") -> Model:
    """A model of all rows of ``texts``; null texts count as empty ones."""
    column = F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text")
    rows = texts.select(column)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / SHARD_BYTES))))
    grams = arrow_map(rows, partial(_count_batches, bits=bits), GRAMS)
    dealt = grams.repartition("shard").sortWithinPartitions("shard")
    shards = materialise(arrow_map(dealt, _filter_batches, FILTER), "filter", drop_shuffles=True)
    sent = F.octet_length("bits") + F.octet_length("words") + F.octet_length("word_counts")
    sums = shards.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (sent, "n_tokens", "n_words", "n_pairs")]).first()
    by_level = shards.select(F.posexplode(F.arrays_zip("grams", "totals")).alias("level", "x"))
    by_level = by_level.groupBy("level").agg(F.sum("x.grams").alias("n"), F.sum("x.totals").alias("total")).collect()
    means = np.zeros(2 * LEVELS)
    for row in by_level:
        means[row["level"]] = row["total"] / max(1, row["n"])
    numbers = Numbers(bits, sums[1], sums[2], max(1.0, sums[3] / max(1, sums[2])), means.reshape(2, LEVELS))
    return Model(shards, sums[0], numbers)


BIT = np.left_shift(1, np.arange(8)).astype(np.uint8)


class Filter:
    """Parts of the filter and the word counts that go with them, ready to be asked."""

    def __init__(self, bits: int):
        self.shift_bits = bits
        self.parts: dict[int, tuple[bytes, int, bytes, bytes]] = {}

    def add(self, shard: int, data: bytes, n_bits: int, words: bytes, counts: bytes) -> None:
        self.parts[shard] = (bytes(data), n_bits, bytes(words), bytes(counts))

    def ready(self) -> Filter:
        """Everything end to end; shards that hold nothing answer no."""
        shards = 1 << self.shift_bits
        self.sizes = np.zeros(shards, dtype=np.uint64)
        self.starts = np.zeros(shards, dtype=np.int64)
        at, order = 0, sorted(self.parts)
        for shard in order:
            self.starts[shard], self.sizes[shard] = at, self.parts[shard][1]
            at += 8 * len(self.parts[shard][0])
        self.bytes = np.frombuffer(b"".join([self.parts[s][0] for s in order]), np.uint8)
        # Shards go by the first bits of a hash, so this is sorted.
        self.words = np.frombuffer(b"".join([self.parts[s][2] for s in order]), np.uint64)
        self.counts = np.concatenate(
            [np.frombuffer(c, np.uint32 if 2 * len(c) == len(w) else np.uint64) for _, _, w, c in (self.parts[s] for s in order)] or [np.zeros(0, np.uint32)]
        )
        self.parts = {}
        return self

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Level by level until one is missing."""
        found = np.zeros(len(hashes), dtype=np.int16)
        shards = _shards_of(hashes, self.shift_bits)
        left = np.flatnonzero(self.sizes[shards] > 0)
        level = 0
        while len(left) and level < LEVELS - 1:
            level += 1
            keys, steps = _level_keys(hashes[left], level)
            starts, sizes = (x[shards[left]] if self.shift_bits else x for x in (self.starts, self.sizes))
            for _ in range(PROBES):
                at = starts + _spots(keys, sizes)
                set_ = np.flatnonzero(self.bytes[at >> 3] & BIT[at & 7])
                left, steps = left[set_], steps[set_]
                keys = keys[set_] + steps
                if self.shift_bits:
                    starts, sizes = starts[set_], sizes[set_]
            found[left] = level
        return found

    def word_counts(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.counts[at], 0).astype(np.int64)


def log_probabilities(numbers: Numbers, before: np.ndarray, word: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Of words after others, by the levels of both and of the pair."""
    means = numbers.means
    plain = (means[0][word] + 1) / (numbers.n_tokens + numbers.n_words + 1)
    together = np.minimum(means[1][np.minimum(pair, np.minimum(before, word))], means[0][before])
    return np.log10((together + numbers.followers * plain) / (means[0][before] + numbers.followers))


def base_logs(numbers: Numbers, counts: np.ndarray) -> np.ndarray:
    return np.log10((counts + 1) / (numbers.n_tokens + numbers.n_words + 1))


def _neighbours(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, their place at each token, the distinct pairs as places of both
    words in one number, and the pair's place at each token."""
    words, at = np.unique(flat, return_inverse=True)
    before = np.concatenate((at[-1:], at[:-1]))
    pairs, pair_at = np.unique(before * np.int64(len(words)) + at, return_inverse=True)
    return words, at, pairs, pair_at


SCORES = "n_tokens long, n_known long, base_score double, score double"


def _score_batches(batches: Iterator[pa.RecordBatch], numbers: Numbers, sent) -> Iterator[pa.RecordBatch]:
    held = sent.value
    for batch, texts in (x for b in batches for x in _slices(b, _raw(b.column("text")))):
        flat, sizes = tokens(texts)
        starts = np.cumsum(sizes) - sizes
        if len(flat):
            words, at, pairs, pair_at = _neighbours(flat)
            counts, levels = held.word_counts(words), held.levels(words)
            before, word = np.divmod(pairs, len(words))
            pair_levels = held.levels(pair_hash(words[before], words[word]))
            logs = log_probabilities(numbers, levels[before], levels[word], pair_levels)
            known = np.add.reduceat((counts > 0).astype(np.int64)[at], starts)
            columns = [sizes, known, np.add.reduceat(base_logs(numbers, counts)[at], starts), np.add.reduceat(logs[pair_at], starts)]
        else:
            columns = [np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.float64)]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], *map(pa.array, columns)],
            names=[*names, "n_tokens", "n_known", "base_score", "score"],
        )


GROUPS = "group long, keys binary, sizes binary, texts binary"
GROUPS_TYPE = pa.schema([("group", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()), ("texts", pa.binary())])


def _deal_batches(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Texts by group, compressed, with their keys. Copies that a task meets go once."""
    held, size, seen = {}, 0, set()

    def handed_on() -> pa.RecordBatch:
        rows = {name: [] for name in GROUPS_TYPE.names}
        for group, own in held.items():
            texts = [text for _, text in own]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            parts = (group, b"".join([key for key, _ in own]), sizes.tobytes(), pa.compress(b"".join(texts), "zstd", asbytes=True))
            for name, value in zip(rows, parts):
                rows[name].append(value)
        held.clear()
        return pa.RecordBatch.from_pydict(rows, schema=GROUPS_TYPE)

    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
        numbers = batch.column(0).to_numpy().view(np.uint64) % np.uint64(groups)
        for key, group, text in zip(map(np.ndarray.tobytes, keys), numbers.tolist(), _raw(batch.column(2))):
            if key in seen:
                continue
            if len(seen) > MEMORY:
                seen.clear()
            seen.add(key)
            held.setdefault(group, []).append((key, text))
            size += len(text)
            if size > DEAL_BYTES:
                yield handed_on()
                size = 0
    if held:
        yield handed_on()


def _texts_of(group: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Keys and texts of a group, copies once."""
    found = {}
    for keys, sizes, texts in zip(*(group.column(n).to_pylist() for n in ("keys", "sizes", "texts"))):
        sizes = np.frombuffer(sizes, np.int64)
        data = pa.decompress(texts, int(sizes.sum()), "zstd", asbytes=True)
        ends = np.cumsum(sizes).tolist()
        for i, (at, to) in enumerate(zip([0, *ends], ends)):
            found[keys[16 * i : 16 * i + 16]] = data[at:to]
    return np.frombuffer(b"".join(found), np.int64).reshape(-1, 2), list(found.values())


def _grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and of all pairs, and tokens per text."""
    parts, first, size = [], 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE_BYTES:
            parts.append(tokens(texts[first:i]))
            first, size = i, 0
        size += len(text)
    parts.append(tokens(texts[first:]))
    flat, sizes = (np.concatenate(x) for x in zip(*parts))
    return flat, pair_hash(np.concatenate((flat[-1:], flat[:-1])), flat), sizes


ASKED = "shard long, group long, words binary, pairs binary"
ASKED_TYPE = pa.schema([("shard", pa.int64()), ("group", pa.int64()), ("words", pa.binary()), ("pairs", pa.binary())])


def _ask(group: pa.Table, bits: int) -> pa.Table:
    """One row for each shard that a group has to ask, with its distinct grams there."""
    words, pairs, _ = _grams_of(_texts_of(group)[1])
    words, pairs = _distinct(words), _distinct(pairs)
    firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    of_words, of_pairs = ([*np.searchsorted(x, firsts).tolist(), len(x)] for x in (words, pairs))
    rows = {name: [] for name in ASKED_TYPE.names}
    number = group.column("group")[0].as_py()
    for shard, (a, b, c, d) in enumerate(zip(of_words, of_words[1:], of_pairs, of_pairs[1:])):
        if b > a or d > c:
            for name, value in zip(rows, (shard, number, pack(words[a:b]), pack(pairs[c:d]))):
                rows[name].append(value)
    release()
    return pa.Table.from_pydict(rows, schema=ASKED_TYPE)


ANSWERED = "group long, shard long, words binary, counts binary, pairs binary"
ANSWERED_TYPE = pa.schema(
    [("group", pa.int64()), ("shard", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()), ("pairs", pa.binary())]
)


def _answers(held: Filter, shard: int, asked: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Levels of all grams and counts of the words, in the order of the questions."""
    words, pairs = (np.concatenate([x[i] for x in asked]) for i in (1, 2))
    levels, pair_levels = (held.levels(x).astype(np.uint8) for x in (words, pairs))
    counts = held.word_counts(words)
    rows = {name: [] for name in ANSWERED_TYPE.names}
    at = pair_at = 0
    for group, own, own_pairs in asked:
        to, pair_to = at + len(own), pair_at + len(own_pairs)
        row = (group, shard, levels[at:to].tobytes(), _pack_counts(counts[at:to]), pair_levels[pair_at:pair_to].tobytes())
        for name, value in zip(rows, row):
            rows[name].append(value)
        at, pair_at = to, pair_to
    return pa.RecordBatch.from_pydict(rows, schema=ANSWERED_TYPE)


def _answer_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by shard, a shard's part of the filter before the questions to it. Shards
    that hold nothing have no part and answer no."""
    held, shard, asked, size = Filter(0).ready(), None, [], 0
    for batch in batches:
        for r in batch.to_pylist():
            if asked and (r["shard"] != shard or size > QUESTIONS):
                yield _answers(held, shard, asked)
                asked, size = [], 0
            if r["shard"] != shard:
                held, shard = Filter(0), r["shard"]
                if not r["is_question"]:
                    held.add(0, r["bits"], r["n_bits"], r["words"], r["word_counts"])
                held.ready()
            if r["is_question"]:
                asked.append((r["group"], unpack(r["words"]), unpack(r["pairs"])))
                size += len(asked[-1][1]) + len(asked[-1][2])
    if asked:
        yield _answers(held, shard, asked)


SCORED_TYPE = pa.schema(
    [*[(n, pa.int64()) for n in ("key0", "key1", "n_tokens", "n_known")], ("base_score", pa.float64()), ("score", pa.float64())]
)


def _gather(group: pa.Table, answers: pa.Table, numbers: Numbers) -> pa.Table:
    """Scores of a group's texts. Shards go by the first bits of a hash, so their answers
    end to end are those to the sorted distinct grams."""
    keys, texts = _texts_of(group)
    flat, pairs, sizes = _grams_of(texts)
    n_words, at = _places(flat)
    n_pairs, pair_at = _places(pairs)
    answers = answers.sort_by("shard")
    levels, pair_levels = (np.frombuffer(b"".join(answers.column(n).to_pylist()), np.uint8) for n in ("words", "pairs"))
    counts = np.concatenate([_unpack_counts(c, len(w)) for c, w in zip(*(answers.column(n).to_pylist() for n in ("counts", "words")))])
    if (len(levels), len(pair_levels)) != (n_words, n_pairs):
        raise RuntimeError("answers do not fit the texts of their group")
    starts = np.cumsum(sizes) - sizes
    word = levels[at]
    logs = log_probabilities(numbers, np.concatenate((word[-1:], word[:-1])), word, pair_levels[pair_at])
    known = np.add.reduceat((counts > 0).astype(np.int64)[at], starts)
    columns = [keys[:, 0], keys[:, 1], sizes, known, np.add.reduceat(base_logs(numbers, counts)[at], starts), np.add.reduceat(logs, starts)]
    out = pa.Table.from_arrays([pa.array(c) for c in columns], schema=SCORED_TYPE)
    release()
    return out


def _places(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """How many are distinct, and the place of each among those in order."""
    order = np.argsort(hashes)
    held = hashes[order]
    rank = np.cumsum(np.concatenate(([False], held[1:] != held[:-1])), dtype=np.int32)
    places = np.empty(len(hashes), dtype=np.int32)
    places[order] = rank
    return int(rank[-1]) + 1, places


def _questions(rows: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """The groups of distinct texts, dealt out, and what they ask."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    texts = rows.select("key0", "key1", "text")
    dealt = arrow_map(texts, partial(_deal_batches, groups=max(1, math.ceil(size / GROUP_BYTES))), GROUPS)
    groups = dealt.repartition("group")
    # Spark looks for the arguments' types, which a partial function does not tell.
    return groups, groups.groupBy("group").applyInArrow(lambda group: _ask(group, bits), ASKED)


def _score_by_shards(rows: DataFrame, model: Model, names: list[str]) -> DataFrame:
    rows = rows.select(*names, *[k.alias(f"key{i}") for i, k in enumerate(row_key("text"))], "text")
    groups, asked = _questions(rows, model.numbers.bits)
    parts = model.shards.select("shard", F.lit(False).alias("is_question"), "bits", "n_bits", "words", "word_counts")
    questions = asked.withColumn("is_question", F.lit(True))
    dealt = parts.unionByName(questions, allowMissingColumns=True).repartition("shard").sortWithinPartitions("shard", "is_question")
    answers = arrow_map(dealt, _answer_batches, ANSWERED)
    # Both sides by group: the texts are dealt out once for this and for the questions.
    both, numbers = groups.groupBy("group").cogroup(answers.groupBy("group")), model.numbers
    scored = both.applyInArrow(lambda group, own: _gather(group, own, numbers), f"key0 long, key1 long, {SCORES}")
    scored = materialise(scored, "scored", drop_shuffles=True)
    out = rows.select(*names, "key0", "key1").join(scored.hint("merge"), ["key0", "key1"])
    return out.select(*names, "n_tokens", "n_known", "base_score", "score")


def score(
    docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """One row for each row of ``docs``: its ``keep`` columns, ``n_tokens`` (words and one
    end), ``n_known`` (tokens that training texts have), ``base_score`` (log10 probability by
    word counts with one added) and ``score`` (by the filter's model).

    A null or empty text is its end alone. Repeated rows stay; columns not in ``keep`` are not
    looked at, whatever their name. An empty table gives an empty result, and a model of
    no text gives every token the probability 1."""
    names = [f"kept{i}" for i in range(len(keep))]
    rows = docs.select(
        *[quoted(c).alias(n) for c, n in zip(keep, names)],
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    )
    if model.size > limit:
        scored = _score_by_shards(rows, model, names)
    else:
        held = Filter(model.numbers.bits)
        for part in model.shards.select("shard", "bits", "n_bits", "words", "word_counts").toLocalIterator():
            held.add(*part)
        sent = docs.sparkSession.sparkContext.broadcast(held.ready())
        kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
        scored = arrow_map(rows, partial(_score_batches, numbers=model.numbers, sent=sent), ", ".join(x for x in (kept, SCORES) if x))
    return scored.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "n_tokens", "n_known", "base_score", "score")
