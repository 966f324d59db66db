"""SentencePiece encoding and decoding with a Viterbi pass that words share.

Texts are cut into marked words (a word with the blank before it; line ends alone), the
distinct words of a batch are sorted, and the sorted list is walked as the depth-first
traversal of a trie: the forward states of the prefix that a word has in common with the
one before it stay on the stack, and only its new characters are computed.

With a unigram model the forward state is the best score of a prefix. A BPE model has
no such scores: its result is defined by the order of merges. But a sequence of pieces
is what BPE makes of a string exactly when each piece is what BPE makes of itself and
every two neighbours are what it makes of both together. So the forward state of a
prefix is the last piece of its encoding, the only one that fits the state before it,
and the same pass gives the same pieces as merging does. ``piece_walk`` makes that pass
for all words of a slice at once, in arrays; very long words, runs of blanks and unigram
models are walked one by one here.

Every task works alone on its batches: no shuffle, and memory bounded by the batch.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, partial
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, quoted
from .piece_walk import Walk

BLANK = "▁"
# Pairs of pieces a worker remembers before it starts afresh.
MEMORY = 150_000
# Words walked one by one whose pieces a worker remembers, in each of two generations.
WORDS = 40_000
# Words of more characters are not remembered, and walked one by one if there are only FEW
# of them in a slice.
LONG, FEW = 256, 32
# Text whose words share a trie, and piece numbers decoded at once, in bytes; one row may
# have more. Twice as much takes a fifth less time and 30 MB more per worker.
SLICE_BYTES = 1 << 20


@dataclass
class Vocabulary:
    """Pieces with their numbers and scores; what is needed to encode and decode."""

    pieces: list[str]
    scores: list[float]
    byte_ids: dict[int, int]
    unigram: bool
    usable: list[bool]
    ids: dict[str, int] = field(init=False)

    def __post_init__(self):
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.usable[i]}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file, on the driver."""
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model

        with open(path, "rb") as file:
            proto = model.ModelProto.FromString(file.read())
        norm = proto.normalizer_spec
        if norm.name != "identity" or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only models that leave text as it is and add a blank before it")
        processor = SentencePieceProcessor(model_file=path)
        numbers = range(processor.vocab_size())
        pieces = [processor.id_to_piece(i) for i in numbers]
        plain = [
            not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))
            for i in numbers
        ]
        inside = [p for i, p in enumerate(pieces) if plain[i] and (BLANK in p.lstrip(BLANK) or "\n" in p)]
        if inside:
            raise ValueError(f"pieces that span words: {inside[:3]}")
        return cls(
            pieces,
            [processor.get_score(i) for i in numbers],
            {int(p[3:5], 16): i for i, p in enumerate(pieces) if processor.is_byte(i)},
            proto.trainer_spec.model_type == 1,
            plain,
        )


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.fits: dict[int, bool] = {}
        # By piece: 0 not known yet, 1 what BPE makes of it, 2 not.
        self.state = bytearray(len(vocabulary.pieces))
        # What the joined strings within stable pieces are made of.
        self.made: dict[str, tuple[str, str]] = {}
        # Words with their pieces, in two generations.
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.lowest = min((vocabulary.scores[i] for i in vocabulary.ids.values()), default=0.0)

    @cached_property
    def lengths(self) -> dict[str, tuple[int, ...]]:
        """The lengths of the pieces that end in given characters, longest first, bound the
        search: by three characters, and by what is left of shorter ones."""
        ends: dict[str, set[int]] = {}
        for piece in self.v.ids:
            ends.setdefault(piece[-3:], set()).add(len(piece))
            for size in (1, 2):
                if len(piece) > size:
                    ends.setdefault(piece[-size:], set())
        return {
            end: tuple(sorted((n for k in range(1, len(end) + 1) for n in ends.get(end[-k:], ()) if n <= k or k == 3), reverse=True))
            for end in ends
        }

    @cached_property
    def walk(self) -> Walk:
        """The pass over many words at once, for BPE models."""
        made: dict[str, tuple[str, str]] = {}
        stable = []
        for piece in self.v.ids:
            parts: dict[str, tuple[str, str]] = {}
            if self.merge(piece, parts) == [piece]:
                stable.append(piece)
                made.update(parts)
        return Walk(self.v.ids, self.v.scores, stable, made, self.v.byte_ids)

    def merge(self, text: str, made: dict[str, tuple[str, str]] | None = None) -> list[str]:
        """BPE by its definition: join the best pair, the leftmost of equals, until none is
        left. The pairs wait in a heap, so a long text takes little more than its length.
        ``made`` is told what each joined pair was made of."""
        ids, scores = self.v.ids, self.v.scores
        parts, after = list(text), list(range(1, len(text) + 1))
        before = list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(parts):
                joined = parts[left] + parts[right]
                found = ids.get(joined)
                if found is not None:
                    heappush(heap, (-scores[found], left, joined))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, left, joined = heappop(heap)
            right = after[left]
            # Pairs of which one side has been joined since are stale.
            if not parts[left] or right >= len(parts) or parts[left] + parts[right] != joined:
                continue
            if made is not None:
                made[joined] = (parts[left], parts[right])
            parts[left], parts[right] = joined, ""
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [p for p in parts if p]

    def _stable(self, piece: str, number: int) -> bool:
        """Whether a piece is what BPE makes of itself."""
        made: dict[str, tuple[str, str]] = {}
        found = self.merge(piece, made) == [piece]
        if found:
            self.made.update(made)
        self.state[number] = 1 if found else 2
        return found

    def _pair(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two pieces as they are, side by side. Nothing merges with a
        character that has no piece (-1), so that is not asked."""
        if len(self.fits) > MEMORY:
            self.fits.clear()
        found = self.separate(self.v.pieces[left], self.v.pieces[right])
        self.fits[left * len(self.v.pieces) + right] = found
        return found

    def separate(self, left: str, right: str) -> bool:
        """Whether no pair across the border of two pieces is ever the best one. Both pieces
        are unmade from the end, the one made later first (of equals the right one, since
        the left one is joined first); what stands at the border in between must not join
        before what was unmade."""
        ids, scores, made = self.v.ids, self.v.scores, self.made
        # A pair across joins first if it is better than this, or as good and to its left.
        bound, also_equal = -math.inf, True
        while True:
            across = ids.get(left + right)
            if across is not None and (scores[across] > bound or also_equal and scores[across] == bound):
                return False
            parts_left, parts_right = made.get(left), made.get(right)
            if parts_left is None and parts_right is None:
                return True
            if parts_right is None or parts_left is not None and scores[ids[left]] < scores[ids[right]]:
                bound, also_equal, left = scores[ids[left]], False, parts_left[1]
            else:
                bound, also_equal, right = scores[ids[right]], True, parts_right[0]

    def _next_bpe(self, word: str, end: int, states: list) -> tuple[int, int]:
        """The last piece of the encoding of ``word[:end]`` and where it starts."""
        ids, state, fits, count = self.v.ids, self.state, self.fits, len(self.v.pieces)
        for size in self._sizes(word, end):
            start = end - size
            number = ids.get(word[start:end])
            if number is None:
                continue
            known = state[number]
            if known != 1 and (known == 2 or not self._stable(word[start:end], number)):
                continue
            if start == 0:
                return number, 0
            left = states[start][0]
            if left < 0:
                return number, start
            found = fits.get(left * count + number)
            if found or found is None and self._pair(left, number):
                return number, start
        return -1, end - 1

    def _sizes(self, word: str, end: int) -> tuple[int, ...] | list[int]:
        """Lengths that a piece ending here may have, longest first."""
        for size in (3, 2, 1):
            if size <= end:
                found = self.lengths.get(word[end - size : end])
                if found is not None:
                    return found if not found or found[0] <= end else [n for n in found if n <= end]
        return ()

    def _next_unigram(self, word: str, end: int, states: list) -> tuple[int, int, float]:
        """The best last piece of ``word[:end]``, where it starts, the total score."""
        ids, scores = self.v.ids, self.v.scores
        before = states[end - 1][2] if end > 1 else 0.0
        single = word[end - 1]
        number = ids.get(single, -1)
        best = (number, end - 1, before + (scores[number] if number >= 0 else self.lowest - 10.0))
        for size in self._sizes(word, end):
            start = end - size
            number = ids.get(word[start:end]) if size > 1 else None
            if number is not None:
                total = (states[start][2] if start else 0.0) + scores[number]
                if total > best[2]:
                    best = (number, start, total)
        return best

    def _bytes(self, text: str) -> list[int]:
        return [self.v.byte_ids.get(b, 0) for b in text.encode("utf-8", "surrogatepass")]

    def encode(self, words: list[str]) -> list[tuple[int, ...]]:
        """Piece numbers of distinct words. Those not known are walked as a trie; with many
        known ones, words that nobody has asked for since the last time are forgotten."""
        if len(self.known) > WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = [w for w in words if w not in known]
        known.update((w, older[w]) for w in new if w in older)
        walked = sorted(w for w in new if w not in older)
        long = {}
        for word, ids in zip(walked, self.encode_sorted(walked)):
            (known if len(word) <= LONG else long)[word] = tuple(ids)
        return [long[w] if w in long else known[w] for w in words]

    def encode_distinct(self, words: pa.StringArray) -> pa.ListArray:
        """Piece numbers of distinct words, in their order."""
        order = pc.array_sort_indices(words)
        words = words.take(order)
        single = np.ones(len(words), bool)
        if not self.v.unigram:
            sizes = pc.utf8_length(words).to_numpy()
            longest = max(LONG, np.partition(sizes, -FEW)[-FEW] if len(sizes) > FEW else LONG)
            blanks = pc.starts_with(words, BLANK * 2).to_numpy(zero_copy_only=False)
            single = blanks | (sizes > longest)
        parts = []
        if not single.all():
            parts.append(self.walk.encode(words.filter(pa.array(~single))))
        if single.any():
            ids = self.encode(words.filter(pa.array(single)).to_pylist())
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.fromiter((i for word in ids for i in word), np.int32, ends[-1])
            parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
        if not parts:
            return pa.array([], pa.list_(pa.int32()))
        # Where the pieces of each word are, from the sorted order and the two parts.
        place = np.empty(len(words), np.int64)
        place[order.to_numpy()[np.argsort(single, kind="stable")]] = np.arange(len(words))
        return pa.concat_arrays(parts).take(pa.array(place))

    def encode_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Piece numbers of sorted distinct words, walked as a trie."""
        step = self._next_unigram if self.v.unigram else self._next_bpe
        states: list = [None]
        previous = ""
        for word in words:
            if not self.v.unigram and word.startswith(BLANK * 2):
                # Pieces of blanks alone all have one score, so what counts between
                # them is their place in the whole run.
                found = [(self.v.ids.get(p, -1), p) for p in self.merge(word)]
                yield [i for n, p in found for i in ([n] if n >= 0 else self._bytes(p))]
                continue
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                states.append(step(word, end, states))
            previous = word
            numbers, end = [], len(word)
            while end:
                number, start = states[end][:2]
                numbers += [number] if number >= 0 else self._bytes(word[start:end])[::-1]
                end = start
            yield numbers[::-1]


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker and vocabulary, so that its memory outlives a task."""
    parts = (vocabulary.pieces, vocabulary.scores, vocabulary.byte_ids, vocabulary.unigram, vocabulary.usable)
    name = hashlib.sha256(pickle.dumps(parts)).hexdigest()
    if name not in _encoders:
        _encoders[name] = Encoder(vocabulary)
    return _encoders[name]


def _marked(texts: pa.StringArray) -> pa.StringArray:
    """The texts with marks for blanks and one more before them; nulls are empty."""
    texts = pc.fill_null(texts, "")
    before = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", BLANK)
    return pc.binary_join_element_wise(before, pc.replace_substring(texts, " ", BLANK), "")


def _chunks(marked: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The words of all texts, and where those of each text begin and the last one's end. A
    word is a run of blanks with what follows it, a line end, or what follows a line end."""
    bounds = np.frombuffer(marked.buffers()[1], np.int32)[marked.offset : marked.offset + len(marked) + 1]
    data = np.frombuffer(marked.buffers()[2] or b"", np.uint8)[: bounds[-1]]
    starts = np.zeros(len(data) + 1, bool)
    starts[bounds] = True
    line_ends = np.flatnonzero(data == 10)
    starts[line_ends] = starts[line_ends + 1] = True
    mark = BLANK.encode()
    blanks = np.flatnonzero(data == mark[0])
    for k in (1, 2):
        blanks = blanks[data[blanks + k] == mark[k]]
    starts[blanks[np.diff(blanks, prepend=-len(mark) - 1) != len(mark)]] = True
    starts[: bounds[0]] = False
    cuts = np.flatnonzero(starts).astype(np.int32)
    words = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), marked.buffers()[2])
    return words, np.searchsorted(cuts, bounds)


def _slices(batch: pa.RecordBatch, lengths: pa.Array, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch in which the lengths sum up to about ``size``. What a part has left
    in Arrow's memory pool goes back before the next one."""
    ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(ends // size)) + 1, [batch.num_rows]))
    for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if stop > start:
            yield batch.slice(start, stop - start)
            pa.default_memory_pool().release_unused()


def _encode_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary)
    for batch in (part for b in batches for part in _slices(b, pc.binary_length(b.column(1)), SLICE_BYTES)):
        words, bounds = _chunks(_marked(batch.column(1).cast(pa.string())))
        distinct = words.dictionary_encode()
        lists = encoder.encode_distinct(distinct.dictionary).take(distinct.indices)
        ends = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset :][bounds] if len(lists) else bounds
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lists.values)
        yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", keep: list[str] | None = None):
    """The ``keep`` columns and the text of each row with ``ids``, its piece numbers.

    A null or empty text has no pieces (and a null stays null in ``text``). Characters
    without a piece become their bytes. Any ``ids`` column of ``docs`` is left out."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (text_col, "ids")]
    carried = F.struct(*keep) if keep else F.lit(None).cast("string")
    rows = docs.select(carried.alias("carried"), F.col(text_col).alias("text"))
    kind = rows.schema["carried"].dataType.simpleString()
    encoded = arrow_map(
        rows, partial(_encode_batches, vocabulary=vocabulary), f"carried {kind}, text string, ids array<int>"
    )
    return encoded.select(*([f"carried.`{c}`" for c in keep]), F.col("text").alias(text_col), "ids")


def _texts(ids: pa.ListArray, pieces: pa.BinaryArray) -> pa.StringArray:
    """What lists of pieces stand for; broken UTF-8 is replaced."""
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    joined = pieces.take(ids.flatten())
    ends = np.frombuffer(joined.buffers()[1], np.int32) if len(joined) else np.zeros(1, np.int32)
    bounds = ends[np.concatenate(([0], np.cumsum(sizes)))]
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[: bounds[-1]]
    # The blank before the text goes.
    marked = bounds[:-1] < bounds[1:]
    marked[marked] = data[bounds[:-1][marked]] == 32
    data = np.delete(data, bounds[:-1][marked])
    bounds = bounds - np.concatenate(([0], np.cumsum(marked)))
    texts = pa.BinaryArray.from_buffers(
        pa.binary(), len(ids), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    )
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.as_py().decode("utf-8", "replace") for t in texts], pa.string())


def _decode_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    pieces = [p.replace(BLANK, " ").encode() if u else b"" for p, u in zip(vocabulary.pieces, vocabulary.usable)]
    for byte, number in vocabulary.byte_ids.items():
        pieces[number] = bytes([byte])
    table = pa.array(pieces, pa.binary())
    for batch in (part for b in batches for part in _slices(b, pc.list_value_length(b.column(1)), SLICE_BYTES // 4)):
        texts = _texts(batch.column(1), table)
        yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=["carried", "ids", "decoded"])


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text its piece numbers stand for; null and empty
    lists stand for the empty text. A text comes back as it was, but for U+2581, which
    the encoding takes for a blank."""
    keep = [c for c in encoded.columns if c != "decoded"]
    others = [quoted(c) for c in keep if c != ids_col]
    carried = F.struct(*others) if others else F.lit(None).cast("string")
    rows = encoded.select(carried.alias("carried"), quoted(ids_col).alias("ids"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("carried", "ids"))
    decoded = arrow_map(rows, partial(_decode_batches, vocabulary=vocabulary), f"{kinds}, decoded string")
    columns = [F.col("ids").alias(c) if c == ids_col else F.col("carried")[c].alias(c) for c in keep]
    return decoded.select(*columns, "decoded")
