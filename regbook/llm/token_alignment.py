"""Alignment of two tokenizers over a corpus, every distinct text once.

Texts are shuffled by their full content; copies become one row with a multiplicity. Each
distinct text is encoded by both tokenizers and cut where tokens of both end at the same
byte. A pair of tokens that end together is a link, and how often each pair of ids is linked
in the corpus is summed with the multiplicities. The measures that rest on those sums are
looked up text by text, and all measures are joined to the documents at the end.

Encoding goes by words: neither tokenizer has a token across a single blank between two
other characters, so a text is cut there and a worker encodes each distinct word once.

The pairs that are linked most often go to the workers, ``PAIRS`` at most; what a text
links besides those is joined with the table of all pairs. No pair in that join is frequent.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise
from .common import arrow_map, quoted, row_key

# Pairs that are sent to all workers (13 bytes each).
PAIRS = 4_000_000
# Words a worker remembers in each of two generations, and pairs it sums up before it
# hands them on.
MEMORY = 100_000
FLUSH = 2_000_000
# Texts whose rows a worker holds at once.
ROWS = 500
# Share of all documents from which a text's copies are met by a broadcast.
HOT_SHARE = 0.001
BLANK = "▁"
# A blank that starts a word in either tokenizer: no white space on either side, under
# any version of what that is.
_OTHER = r"[^\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]"
WORD_START = re.compile(f"(?<={_OTHER}) (?={_OTHER})")
# A word that others may stand before and behind without a change to either.
JOINABLE = re.compile(f" {_OTHER}(?:.*{_OTHER})?", re.DOTALL)
# New words that are encoded in one go.
CHUNK = 2_000
SEPARATORS = (",", "|", ";", "\n")


@dataclass(frozen=True)
class Models:
    """Both vocabulary files, read on the driver and sent along with the tasks."""

    byte_level: str
    pieces: bytes

    @classmethod
    def load(cls, byte_level_path: str, pieces_path: str) -> Models:
        with open(byte_level_path, encoding="utf-8") as a, open(pieces_path, "rb") as b:
            models = cls(a.read(), b.read())
        Aligner(models)
        return models


def _byte_of() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones stand
    for themselves, the others are numbered from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    def __init__(self, models: Models):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(models.byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=models.pieces)
        byte = _byte_of()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte.get(c, 0) for c in token)
        self.b_bytes, self.n_b = [], self.b.vocab_size()
        for i in range(self.n_b):
            piece = self.b.id_to_piece(i)
            if BLANK in piece.lstrip(BLANK):
                raise ValueError(f"a piece that spans words: {piece!r}")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode())
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        # word -> (A tokens, B tokens, groups or None, linked pairs)
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def recall(self, words: Iterable[str]) -> None:
        """Make all these words known. When there are many, words that nobody has asked for
        since the last time are forgotten."""
        if len(self.known) > MEMORY:
            self.known, self.older = {}, self.known
        new = [w for w in words if w not in self.known]
        older = self.older
        self.known.update((w, older[w]) for w in new if w in older)
        if unknown := [w for w in new if w not in older]:
            self.learn(sorted(unknown))

    def learn(self, words: list[str]) -> None:
        """Encode words (each with the blank before it) and remember what they give."""
        alone, joinable = [], []
        for word in words:
            (joinable if JOINABLE.fullmatch(word) else alone).append(word)
        for i in range(0, len(joinable), CHUNK):
            chunk = joinable[i : i + CHUNK]
            found = self._align_joined(chunk)
            if found is None:
                alone += chunk
            else:
                self.known.update(zip(chunk, found))
        ours = self.a.encode_batch_fast(alone, add_special_tokens=False)
        theirs = self.b.encode([w[1:] for w in alone], num_threads=1)
        for word, a, b in zip(alone, (e.ids for e in ours), theirs):
            self.known[word] = self._align(word.encode(), a, b)

    def _align_joined(self, words: list[str]) -> list[tuple] | None:
        """What ``_align`` gives for each of the words, from their encoding as one text;
        ``None`` if one of them is not given back as it is."""
        text = "".join(words)
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:])
        raw = text.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.cumsum([len(w.encode()) for w in words])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        at = np.searchsorted(common, ends)
        if (common[np.minimum(at, len(common) - 1)] != ends).any():
            return None
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        last_a, last_b = ends_a == common[group_a], ends_b == common[group_b]
        closes = np.zeros(len(common), dtype=bool)
        closes[at] = True
        # All tokens by group, those of A first, each with what stands behind it.
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        behind = np.concatenate((last_a.astype(int), np.where(last_b, np.where(closes[group_b], 3, 2), 0)))[order]
        ids = np.concatenate((a, b))[order]
        groups = "".join([f"{i}{SEPARATORS[x]}" for i, x in zip(ids.tolist(), behind.tolist())]).split("\n")
        pairs = (a[last_a] * self.n_b + b[last_b]).tolist()
        counts = [np.diff(np.searchsorted(e, ends, side="right"), prepend=0).tolist() for e in (ends_a, ends_b)]
        starts = [0, *(at + 1).tolist()]
        return [
            (n_a, n_b, group, tuple(pairs[i:j])) for n_a, n_b, group, i, j in zip(*counts, groups, starts, starts[1:])
        ]

    def _align(self, raw: bytes, a: list[int], b: list[int]) -> tuple:
        ours, theirs = self.a_bytes, self.b_bytes
        if b"".join([ours[i] for i in a]) != raw or b"".join([theirs[i] for i in b]) != raw:
            return 0, 0, None, ()
        groups, pairs, first_a, first_b = [], [], 0, 0
        i = j = at_a = at_b = 0
        while i < len(a):
            if at_a <= at_b:
                at_a += len(ours[a[i]])
                i += 1
            while at_b < at_a:
                at_b += len(theirs[b[j]])
                j += 1
            if at_a == at_b:
                groups.append(",".join(map(str, a[first_a:i])) + "|" + ",".join(map(str, b[first_b:j])))
                pairs.append(a[i - 1] * self.n_b + b[j - 1])
                first_a, first_b = i, j
        return len(a), len(b), ";".join(groups), tuple(pairs)


_aligners: dict[str, Aligner] = {}


def _aligner(models: Models) -> Aligner:
    """One aligner per worker and pair of vocabularies, so that its memory outlives a task."""
    name = hashlib.sha256(models.byte_level.encode() + b"\0" + models.pieces).hexdigest()
    if name not in _aligners:
        _aligners[name] = Aligner(models)
    return _aligners[name]


def words_of(text: str) -> list[str]:
    """A text with a blank before it as words, each with the blank before it."""
    first, *rest = WORD_START.split(" " + text)
    return [first, *[" " + w for w in rest]]


MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _lists(values: np.ndarray, sizes: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values))


def _align_batches(batches: Iterator[pa.RecordBatch], models: Models, groups: bool) -> Iterator[pa.RecordBatch]:
    aligner = _aligner(models)
    for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        texts = [words_of(t) if t else [] for t in batch.column("text").to_pylist()]
        places: dict[str, int] = {}
        at_words = [np.array([places.setdefault(w, len(places)) for w in words], dtype=np.int64) for words in texts]
        del texts
        aligner.recall(places.keys())
        found = [aligner.known[w] for w in places]
        known_groups = [f[2] for f in found]
        usable = np.array([g is not None for g in known_groups], dtype=bool)
        numbers = np.array([(f[0], f[1], len(f[3])) for f in found], dtype=np.int64).reshape(-1, 3)
        flat = np.array([p for f in found for p in f[3]], dtype=np.int64)
        firsts = np.cumsum(numbers[:, 2]) - numbers[:, 2]
        rows, joined, codes, counts, sizes = [], [], [], [], []
        for at in at_words:
            if not len(at) or not usable[at].all():
                rows.append((0, 0, 0, ""))
                joined.append("")
                sizes.append(0)
                continue
            n_a, n_b, links = numbers[at].sum(axis=0).tolist()
            text = ";".join([known_groups[i] for i in at.tolist()])
            each = numbers[at, 2]
            place = np.arange(links) + np.repeat(firsts[at] - (np.cumsum(each) - each), each)
            rows.append((n_a, n_b, links, hashlib.sha256(text.encode()).hexdigest()))
            joined.append(text if groups else "")
            own, n = np.unique(flat[place], return_counts=True)
            codes.append(own)
            counts.append(n)
            sizes.append(len(own))
        n_a, n_b, links, sha = zip(*rows)
        totals = [pa.array(c, pa.int64()) for c in (n_a, n_b, links, links)]
        kept = [c for n, c in zip(batch.schema.names, batch.columns) if n != "text"]
        empty = [np.zeros(0, np.int64)]
        pairs = [_lists(np.concatenate(codes + empty), sizes), _lists(np.concatenate(counts + empty).astype(np.int32), sizes)]
        own = [pa.array(joined, pa.string())] if groups else []
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*kept, *totals, pa.array(sha, pa.string()), *pairs, *own],
            names=[*names, *MEASURES, "groups_sha256", "codes", "counts", *["groups"][: len(own)]],
        )


def align_texts(texts: DataFrame, models: Models, groups: bool = False) -> DataFrame:
    """``texts`` (with a column ``text``) with numbers of tokens, groups and links in place
    of the text, the hash of its groups, its pairs as ``codes`` (A's id times the size of
    B's vocabulary plus B's id) with ``counts``, and with ``groups`` written out if asked for."""
    kept = texts.drop("text")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields)
    schema = f"{schema}{ALIGNED}, codes array<bigint>, counts array<int>" + ", groups string" * groups
    return arrow_map(texts.select(*kept.columns, "text"), partial(_align_batches, models=models, groups=groups), schema)


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of pairs, weighted by copies; summed up within the task first."""
    codes, weights, size = [], [], 0

    def summed() -> pa.RecordBatch:
        distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(total, place, np.concatenate(weights))
        return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(total)], names=["code", "n"])

    for batch in batches:
        lists, counts = batch.column("codes"), batch.column("counts")
        copies = batch.column("copies").to_numpy(zero_copy_only=False)
        own = counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        codes.append(lists.flatten().to_numpy(zero_copy_only=False))
        weights.append(own * np.repeat(copies, np.diff(lists.offsets.to_numpy())))
        size += len(own)
        if size > FLUSH:
            whole = summed()
            codes, weights, size = [whole.column(0).to_numpy()], [whole.column(1).to_numpy()], 0
            if len(codes[0]) > FLUSH:
                yield whole
                codes, weights = [], []
    if codes:
        yield summed()


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``(code, n, best)``: how many links hold a pair, and whether no other pair with the
    same id of B is held by more."""
    partial_sums = arrow_map(aligned.select("codes", "counts", "copies"), _sum_batches, "code long, n long")
    pairs = materialise(partial_sums.groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    # One row for each id of B.
    most = pairs.groupBy((F.col("code") % n_b).alias("b")).agg(F.max("n").alias("most"))
    judged = pairs.withColumn("b", F.col("code") % n_b).join(F.broadcast(most), "b")
    return materialise(judged.select("code", "n", (F.col("n") == F.col("most")).alias("best")), "judged-pairs")


def _look_up(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    codes, n, best = sent.value
    for batch in batches:
        lists = batch.column("codes")
        own = lists.flatten().to_numpy(zero_copy_only=False)
        counts = batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        if len(codes):
            at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            hit = codes[at] == own
        else:
            at, hit = np.zeros(len(own), np.int64), np.zeros(len(own), bool)
        totals = np.zeros((2, batch.num_rows), dtype=np.int64)
        np.add.at(totals[0], text[hit], (counts * best[at] if len(codes) else counts)[hit])
        np.add.at(totals[1], text[hit], (counts * n[at] if len(codes) else counts)[hit])
        left = ~hit
        sizes = np.bincount(text[left], minlength=batch.num_rows)
        names = [x for x in batch.schema.names if x not in ("codes", "counts")]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(x) for x in names],
                pa.array(totals[0]),
                pa.array(totals[1]),
                _lists(own[left], sizes),
                _lists(counts[left].astype(np.int32), sizes),
            ],
            names=[*names, "n_best", "count_sum", "codes", "counts"],
        )


def frequent_pairs(pairs: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The pairs linked most often, ``most`` at most, and whether that is all of them."""
    total = pairs.count()
    if total <= most:
        return pairs, True
    limit = pairs.agg(F.percentile_approx("n", 1 - most / total, 1000)).first()[0]
    while (kept := pairs.filter(F.col("n") > limit)).count() > most:
        limit *= 2
    return kept, False


def link_measures(aligned: DataFrame, pairs: DataFrame, most: int = PAIRS) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` in place of its pairs; ``key0`` and
    ``key1`` must tell its rows apart."""
    spark = aligned.sparkSession
    frequent, all_of_them = frequent_pairs(pairs, most)
    held = frequent.toArrow()
    codes, n, best = (held.column(i).to_numpy() for i in range(3))
    order = np.argsort(codes)
    sent = spark.sparkContext.broadcast((codes[order], n[order], best[order].astype(bool)))
    kept = aligned.drop("codes", "counts")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    schema = f"{schema}, n_best long, count_sum long, codes array<bigint>, counts array<int>"
    found = arrow_map(aligned.select(*kept.columns, "codes", "counts"), partial(_look_up, sent=sent), schema)
    if all_of_them:
        return found.drop("codes", "counts")
    found = materialise(found, "found")
    links = found.select("key0", "key1", F.explode(F.arrays_zip("codes", "counts")).alias("link"))
    links = links.select("key0", "key1", F.col("link.codes").alias("code"), F.col("link.counts").alias("times"))
    rest = links.join(pairs.hint("merge"), "code").groupBy("key0", "key1").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    joined = found.drop("codes", "counts").join(rest, ["key0", "key1"], "left")
    return joined.select(
        *kept.columns,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


OUT = (*MEASURES, "n_best", "count_sum", "groups_sha256")


def align(docs: DataFrame, models: Models, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", most: int = PAIRS) -> DataFrame:
    """One row for each row of ``docs``: its ``keep`` columns, ``n_a`` and ``n_b`` tokens,
    ``n_groups``, ``n_links``, ``n_best`` (links whose pair is the most frequent of its id
    of B in the corpus, ties included), ``count_sum`` (the corpus count of the pair, summed
    over links) and ``groups_sha256`` (hash of ``a1,a2|b1;a3|b2,b3``).

    A blank is put before every text. A text that is null, empty, or that either tokenizer
    does not give back byte for byte has no tokens: zeros and an empty hash, and it counts
    in no pair. Repeated rows stay; columns not in ``keep`` are not looked at, whatever
    their name. An empty table gives an empty result.
    """
    rows = docs.select(
        *[quoted(c).alias(f"kept{i}") for i, c in enumerate(keep)],
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    )
    texts = rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.select(*[k.alias(f"key{i}") for i, k in enumerate(row_key("text"))], "copies", "text")
    aligned = materialise(align_texts(texts, models), "aligned")
    pairs = pair_counts(aligned, Aligner(models).n_b)
    measured = materialise(link_measures(aligned, pairs, most), "measured")

    # A text with many copies is met by a broadcast; there are 1 / HOT_SHARE at most.
    total = measured.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") >= max(2.0, total * HOT_SHARE)
    keyed = rows.select(*[f"kept{i}" for i in range(len(keep))], *[k.alias(f"key{i}") for i, k in enumerate(row_key("text"))])
    heavy = F.broadcast(measured.filter(hot).drop("copies"))
    light = measured.filter(~hot).drop("copies").hint("merge")
    names = [f"kept{i}" for i in range(len(keep))]
    by_key = ["key0", "key1"]
    first = keyed.join(heavy, by_key).select(*names, *OUT)
    others = keyed.join(heavy.select(*by_key), by_key, "left_anti").join(light, by_key).select(*names, *OUT)
    out = first.unionByName(others)
    return out.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(keep)], *OUT)
