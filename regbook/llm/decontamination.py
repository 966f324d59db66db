"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units are replaced with typed placeholders,
every other word is lower-cased and stripped of punctuation at its ends. Windows of
``WINDOW`` template words are hashed, and document windows are hash-joined with those of
the benchmark items. A hit is checked by its slots: over the aligned windows of a
document and an item, the same item value must always stand for the same document value
and the other way round. Windows that hold a value which breaks this do not count, unless
all their slots are filled as in the item. Questions asked again with other numbers or
names thus match, while chance templates with unrelated fillings do not, and a copy stays
one if some of its values were changed.

An item without a window of its own (too short, or nearly all placeholders) has one key
instead: all its words as they are.

The benchmark is the small side, but its size is never taken for granted: its windows go
to the workers in blocks of at most ``BLOCK`` hashes, all documents against each block,
so document windows that meet no item are never shuffled. The hits are few and are
joined with the item windows by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise
from .common import arrow_map, quoted

WINDOW = 8
# Plain words a window needs; placeholders alone say too little.
MIN_PLAIN = 5
# Hashes sent to the workers at once (32 MB).
BLOCK = 4_000_000
# Words a worker remembers before it starts afresh.
MEMORY = 150_000
# Texts worked on at once.
ROWS = 500

# Units of measure and of currency, written after or against a number.
UNITS = frozenset(
    "% $ € £ ¥ ° °c °f mm cm m km ft yd mg g kg t lb oz ml l s ms sec secs second seconds "
    "min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    "mph kph km/h m/s hz khz mhz ghz w kw mw v a j kj cal kcal n pa kpa usd eur gbp dollar "
    "dollars euro euros pound pounds cent cents percent degree degrees inch inches foot feet "
    "mile miles meter meters metre metres kilometer kilometers kilogram kilograms gram grams "
    "liter liters litre litres".split()
)
NUMBER = re.compile(r"[+-]?[$€£¥]?\d[\d.,:/]*(?:st|nd|rd|th)?(%|°[cf]?|[a-z]{1,3}(?:/[a-z])?)?")
EDGES = " .,;:!?\"'()[]{}<>«»“”‘’„…*#-–—|"
PLAIN, NUM, UNIT, NAME = range(4)


class Words:
    """What the words of a text turn into; one number per distinct word."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.hashes: list[int] = []
        self.kinds: list[int] = []
        self.values: list[int] = []
        self.capital: list[bool] = []
        self.ends: list[bool] = []

    def number(self, word: str) -> int:
        found = self.numbers.get(word)
        if found is None:
            found = self.numbers[word] = len(self.hashes)
            core = word.strip(EDGES)
            low = core.lower()
            kind = PLAIN
            if NUMBER.fullmatch(low):
                kind = NUM
            elif low in UNITS and len(low) > 1 or low in ("%", "$", "€", "£", "¥", "°"):
                kind = UNIT
            self.kinds.append(kind)
            self.values.append(_hash(low))
            self.hashes.append(_hash(low if kind == PLAIN else f"\0{kind}"))
            self.capital.append(kind == PLAIN and core[:1].isupper() and core[1:].islower())
            self.ends.append(word.rstrip("\"')]»”’")[-1:] in (".", "!", "?", ":", "…") or not core)
        return found

    def templates(self, texts: list[str | None]):
        """Template hash, value hash and kind of every word, three arrays per text."""
        numbered = [np.fromiter(map(self.number, (t or "").split()), dtype=np.int64) for t in texts]
        known = (
            np.array(self.hashes, dtype=np.uint64),
            np.array(self.values, dtype=np.uint64),
            np.array(self.kinds, dtype=np.int8),
            np.array(self.capital, dtype=bool),
            np.array(self.ends, dtype=bool),
        )
        for ids in numbered:
            hashes, values, kinds, capital, ends = (a[ids] for a in known)
            if len(ids):
                # A capital inside a sentence makes a name.
                name = capital & ~np.concatenate(([True], ends[:-1]))
                hashes = np.where(name, NAME_HASH, hashes)
                kinds = np.where(name, NAME, kinds)
            yield hashes, values, kinds

    def full(self) -> bool:
        return len(self.hashes) > MEMORY


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 3)


NAME_HASH = np.uint64(_hash(f"\0{NAME}"))


def window_hashes(hashes: np.ndarray, kinds: np.ndarray, window: int, min_plain: int):
    """Start and hash of every window with enough plain words."""
    n = len(hashes) - window + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        total = total * np.uint64(0x9E3779B97F4A7C15) + (hashes[i : i + n] ^ (hashes[i : i + n] >> np.uint64(29)))
    plain = np.concatenate(([0], np.cumsum(kinds == PLAIN)))
    starts = np.flatnonzero(plain[window:] - plain[:-window] >= min_plain)
    return starts, total[starts]


def _slots(values: np.ndarray, kinds: np.ndarray, start: int, window: int) -> list[int]:
    """The slot values of a window in order; the template tells their kinds."""
    part = slice(start, start + window)
    return values[part][kinds[part] != PLAIN].view(np.int64).tolist()


def exact_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every ``length`` words as they are, apart from those of templates."""
    n = len(values) - length + 1
    total = np.full(max(0, n), length, dtype=np.uint64)
    for i in range(length if n > 0 else 0):
        total = total * np.uint64(0xD6E8FEB86659FD93) + (values[i : i + n] ^ (values[i : i + n] >> np.uint64(31)))
    return total


def _keys(values, hashes, kinds, window: int, min_plain: int, lengths: tuple[int, ...] | None):
    """(start, length, hash) of all keys of a text: template windows, and words as they are
    of the given lengths, which are told apart by a minus. Without lengths the text is an
    item."""
    at, found = window_hashes(hashes, kinds, window, min_plain)
    sizes = np.full(len(at), window)
    if lengths is None:
        lengths = () if len(at) or not len(values) else (len(values),)
    for length in lengths:
        exact = exact_hashes(values, length)
        at = np.concatenate((at, np.arange(len(exact))))
        sizes = np.concatenate((sizes, np.full(len(exact), -length)))
        found = np.concatenate((found, exact))
    return at, sizes, found


def _window_batches(
    batches: Iterator[pa.RecordBatch],
    window: int,
    min_plain: int,
    wanted: np.ndarray | None,
    lengths: tuple[int, ...] | None,
) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        keys, starts, lasts, found, slots = [], [], [], [], []
        templates = words.templates(batch.column(1).to_pylist())
        for key, (hashes, values, kinds) in zip(batch.column(0).to_pylist(), templates):
            at, sizes, windows = _keys(values, hashes, kinds, window, min_plain, lengths)
            if wanted is not None and len(windows):
                place = np.minimum(np.searchsorted(wanted, windows), len(wanted) - 1)
                hit = wanted[place] == windows
                at, sizes, windows = at[hit], sizes[hit], windows[hit]
            keys += [key] * len(at)
            starts += at.tolist()
            lasts += sizes.tolist()
            found.append(windows)
            slots += [_slots(values, kinds, i, abs(n)) for i, n in zip(at.tolist(), sizes.tolist())]
        if words.full():
            words = Words()
        hashes = np.concatenate(found) if found else np.empty(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, batch.column(0).type),
                pa.array(starts, pa.int32()),
                pa.array(lasts, pa.int32()),
                pa.array(hashes.view(np.int64)),
                pa.array(slots, pa.list_(pa.int64())),
            ],
            names=["id", "start", "length", "window", "slots"],
        )


def _windows(
    rows: DataFrame,
    window: int,
    min_plain: int,
    wanted: np.ndarray | None = None,
    lengths: tuple[int, ...] | None = None,
) -> DataFrame:
    kind = rows.schema[0].dataType.simpleString()
    schema = f"id {kind}, start int, length int, window long, slots array<long>"
    how = partial(_window_batches, window=window, min_plain=min_plain, wanted=wanted, lengths=lengths)
    return arrow_map(rows, how, schema)


def _hits(rows: DataFrame, items: DataFrame, window: int, min_plain: int, block: int) -> DataFrame:
    """The windows of ``rows`` that some item has, found block by block."""
    # Hashes are spread evenly over their range, so equal parts of it are equal blocks;
    # twice as many as needed on average leaves no block above the bound.
    distinct = items.select("window").distinct()
    blocks = -(-2 * distinct.count() // block) or 1
    # A length of items that have one key is looked for once, whoever has it.
    whole = items.filter("length < 0").select("length").distinct()
    lengths = tuple(sorted(-r[0] for r in whole.collect()))
    found = []
    for i in range(blocks):
        part = distinct.filter(F.pmod("window", F.lit(blocks)) == i).toArrow().column(0).to_numpy()
        if len(part):
            wanted = np.sort(part.view(np.uint64))
            found.append(_windows(rows, window, min_plain, wanted, lengths))
    if not found:
        return _windows(rows.limit(0), window, min_plain)
    return reduce(DataFrame.unionByName, found)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_plain: int = MIN_PLAIN,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, n_windows, first_word, same_slots)`` for each document and
    benchmark item that share windows with consistent slots.

    ``n_windows`` counts the document's windows that match at the same offset between
    the two texts and whose slots contradict none of the others, ``first_word`` is where the
    first starts, ``same_slots`` tells whether all their slot values are equal too (a copy)
    or only consistent (asked again with other values). Null and empty texts share
    nothing; an item without a template window is found by all its words as they are. Rows without an id are left out of the pairs unless ``id_col`` is filled
    before. Repeated rows give the same pair once; several runs of one item in a
    document, too, with the best of them."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    asked = benchmark.select(quoted(item_col).alias("id"), quoted(item_text_col).alias("text"))
    items = materialise(_windows(asked, window, min_plain), "item-windows")
    hits = materialise(_hits(rows, items, window, min_plain, block), "hits")
    met = hits.withColumnsRenamed({"id": "doc_id", "start": "at", "slots": "doc_slots"}).join(
        items.withColumnsRenamed({"id": "item_id", "slots": "item_slots"}), "window"
    )
    # Windows at one offset between the texts belong to one passage. Overlapping windows
    # repeat a slot; as long as it is filled alike everywhere that changes nothing.
    run = ["doc_id", "item_id", "offset"]
    placed = met.withColumn("offset", F.col("at") - F.col("start"))
    slots = placed.select(*run, F.explode(F.arrays_zip("doc_slots", "item_slots")).alias("s"))
    pairs = slots.select(*run, F.col("s.doc_slots").alias("d"), F.col("s.item_slots").alias("i")).distinct()
    # Values that stand for two; a passage has at most as many as the item has slots.
    several = [
        pairs.groupBy(*run, side).agg(F.count("*").alias("n")).filter("n > 1").groupBy(*run).agg(
            F.collect_list(side).alias(f"broken_{side}")
        )
        for side in ("d", "i")
    ]
    none = F.array().cast("array<bigint>")
    judged = placed.join(several[0], run, "left").join(several[1], run, "left")
    broken = F.arrays_overlap("doc_slots", F.coalesce("broken_d", none)) | F.arrays_overlap(
        "item_slots", F.coalesce("broken_i", none)
    )
    same = F.col("doc_slots") == F.col("item_slots")
    good = judged.filter(same | ~broken).groupBy(*run).agg(
        F.count_distinct("at").alias("n_windows"),
        F.min("at").cast("long").alias("first_word"),
        F.bool_and(same).alias("same_slots"),
    )
    return good.groupBy("doc_id", "item_id").agg(
        F.max("n_windows").alias("n_windows"),
        F.min_by("first_word", F.struct(-F.col("n_windows"), F.col("first_word"))).alias("first_word"),
        F.bool_or("same_slots").alias("same_slots"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the rows whose text shares a checked window with an item. Rows
    are told apart by their text here, so an id may be null or repeat."""
    keyed = docs.select(F.xxhash64("text").alias("text_key"), "text").filter("text is not null")
    found = contaminated(keyed, benchmark, id_col="text_key", **how)
    bad = materialise(found.select("doc_id").distinct().withColumnRenamed("doc_id", "bad"), "contaminated")
    return docs.join(bad, F.xxhash64("text") == bad.bad, "left_anti")
