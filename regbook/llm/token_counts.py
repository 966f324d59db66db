"""Token counts that follow edits.

A text is cut into pre-tokens, and ``LEAF`` of them at a time are a leaf of a segment
tree whose nodes hold the sums of characters, tokens and pre-tokens below them. An edit
is located by walking down the character sums; only the leaves it touches are encoded
again, with the boundary context to their left that their first pre-token may depend on,
and to the right until pre-tokens end where a leaf ended before. From there on nothing
can differ, since a pre-token depends on the text from its start alone. The sums on the
paths to the changed leaves are updated, and the root has the new count.

Trees travel as columns, one array per sum in heap order (node ``i`` has the children
``2 i`` and ``2 i + 1``), so they can be stored with the corpus and updated later.
"""

from __future__ import annotations

import base64
import hashlib
import pickle
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, quoted

# Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 32
# Pre-tokens a worker remembers before it starts afresh.
MEMORY = 150_000
CHARS, TOKENS, PRE = range(3)


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of base64 pieces and ranks, read on the driver."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex
        import tiktoken

        self.split = regex.compile(PATTERN).findall
        self.next = regex.compile(PATTERN).match
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def size(self, pre_token: str) -> int:
        found = self.known.get(pre_token)
        if found is None:
            if len(self.known) > MEMORY:
                self.known.clear()
            found = self.known[pre_token] = len(self.encoding.encode_ordinary(pre_token))
        return found

    def tree(self, text: str) -> np.ndarray:
        """The three sums of every node; row 0 is unused, row 1 the root."""
        pre = self.split(text)
        sizes = np.zeros((len(pre), 3), dtype=np.int32)
        sizes[:, CHARS] = list(map(len, pre))
        sizes[:, TOKENS] = list(map(self.size, pre))
        sizes[:, PRE] = 1
        return _tree_of(np.add.reduceat(sizes, np.arange(0, len(pre), LEAF)) if pre else sizes)

    def edit(
        self, text: str, tree: np.ndarray, edits: list[tuple[int, int, str]]
    ) -> tuple[str, np.ndarray, int]:
        """``text`` with each edit's ``put`` in place of ``start:end``, its tree, and how many
        pre-tokens were encoded for that. Edits are in order, in places of the text as it
        was, and do not overlap. One sweep makes them all."""
        pieces, at = [], 0
        for start, end, put in edits:
            pieces += [text[at:start], put]
            at = end
        new = "".join([*pieces, text[at:]])
        width = len(tree) // 2
        regions, i, grown, encoded = [], 0, 0, 0
        while i < len(edits):
            first, offset = self._needed_from(tree, edits[i])
            last, border = first, offset + int(tree[width + first][CHARS])
            at, sizes = offset + grown, []
            while True:
                # Take in the edits that need these leaves.
                while i < len(edits) and self._needed_from(tree, edits[i])[0] <= last:
                    start, end, put = edits[i]
                    reach, place = _leaf_at(tree, max(start, end - 1))
                    if reach > last:
                        last, border = reach, place + int(tree[width + reach][CHARS])
                    grown += len(put) - (end - start)
                    i += 1
                while at < border + grown and (match := self.next(new, at)):
                    at = match.end()
                    sizes.append((at - match.start(), self.size(match[0]), 1))
                # In step with the old text again, unless the next edit is near.
                if at == border + grown and (i == len(edits) or self._needed_from(tree, edits[i])[0] > last):
                    break
                if at > border + grown:
                    last += 1
                    border += int(tree[width + last][CHARS])
            regions.append((first, last, np.array(sizes, dtype=np.int32).reshape(-1, 3)))
            encoded += len(sizes)
        return new, _with_regions(tree, regions), encoded

    def _needed_from(self, tree: np.ndarray, edit: tuple[int, int, str]) -> tuple[int, int]:
        """The leaf to encode from for an edit, and where it starts: the pre-token before an
        edit may change if the edit is at its end, the one before that cannot."""
        width = len(tree) // 2
        leaf, offset = _leaf_at(tree, edit[0])
        before = 0
        while leaf > 0 and before < 2:
            leaf -= 1
            offset -= int(tree[width + leaf][CHARS])
            before += int(tree[width + leaf][PRE])
        return leaf, offset


def _tree_of(leaves: np.ndarray) -> np.ndarray:
    """The tree above some leaves."""
    width = 1 << max(0, len(leaves) - 1).bit_length()
    tree = np.zeros((2 * width, 3), dtype=np.int32)
    tree[width : width + len(leaves)] = leaves
    level = width
    while level > 1:
        tree[level // 2 : level] = tree[level : 2 * level : 2] + tree[level + 1 : 2 * level : 2]
        level //= 2
    return tree


def _with_regions(tree: np.ndarray, regions: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """The tree with new pre-tokens in place of some leaves. They are spread evenly over
    the leaves they replace; where that would make leaves of more than twice ``LEAF``,
    there are new leaves and the sums are made anew."""
    width = len(tree) // 2
    if all(len(sizes) <= 2 * LEAF * (last - first + 1) for first, last, sizes in regions):
        for first, last, sizes in regions:
            leaves = np.zeros((last - first + 1, 3), dtype=np.int32)
            each = max(1, -(-len(sizes) // len(leaves)))
            if len(sizes):
                own = np.add.reduceat(sizes, np.arange(0, len(sizes), each))
                leaves[: len(own)] = own
            _replace(tree, first, leaves)
        return tree
    parts, at = [], 0
    for first, last, sizes in regions:
        parts.append(tree[width + at : width + first])
        if len(sizes):
            parts.append(np.add.reduceat(sizes, np.arange(0, len(sizes), LEAF)))
        at = last + 1
    leaves = np.concatenate([*parts, tree[width + at :]])
    return _tree_of(leaves[leaves[:, PRE] > 0])


def _leaf_at(tree: np.ndarray, place: int) -> tuple[int, int]:
    """The leaf that holds a character and where that leaf starts; the last leaf that
    is not empty for places at the end."""
    width = len(tree) // 2
    node, start = 1, 0
    place = min(place, max(0, int(tree[1][CHARS]) - 1))
    while node < width:
        node *= 2
        left = int(tree[node][CHARS])
        if place - start >= left:
            start += left
            node += 1
    return node - width, start


def _replace(tree: np.ndarray, first: int, leaves: np.ndarray) -> None:
    """Put leaves in and bring the sums above them up to date."""
    low = len(tree) // 2 + first
    high = low + len(leaves) - 1
    tree[low : high + 1] = leaves
    while low > 1:
        low, high = low // 2, high // 2
        tree[low : high + 1] = tree[2 * low : 2 * high + 1 : 2] + tree[2 * low + 1 : 2 * high + 2 : 2]


_counters: dict[str, Counter] = {}


def _counter(ranks: dict[bytes, int]) -> Counter:
    """One counter per worker and vocabulary, so that its memory outlives a task."""
    name = hashlib.sha256(pickle.dumps(ranks)).hexdigest()
    if name not in _counters:
        _counters[name] = Counter(ranks)
    return _counters[name]


TREE = "struct<chars: array<int>, tokens: array<int>, pre: array<int>>"
TREE_TYPE = pa.struct([(n, pa.list_(pa.int32())) for n in ("chars", "tokens", "pre")])


def _tree_arrays(trees: list[np.ndarray]) -> pa.Array:
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(t) for t in trees]))).astype(np.int32))
    flat = np.concatenate(trees) if trees else np.zeros((0, 3), np.int32)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(flat[:, i]))) for i in range(3)]
    return pa.StructArray.from_arrays(lists, fields=list(TREE_TYPE))


def _tree_batches(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    counter = _counter(ranks)
    for batch in batches:
        trees = [counter.tree(text.as_py() or "") for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, _tree_arrays(trees)], names=["carried", "text", "tree"])


def count_tokens(docs: DataFrame, ranks: dict[bytes, int], text_col: str = "text") -> DataFrame:
    """``docs`` with ``tree``, the segment tree of each text, and ``n_tokens``, its root.

    A null or empty text has no tokens. Columns of these names are replaced."""
    keep = [c for c in docs.columns if c not in (text_col, "tree", "n_tokens")]
    rows = docs.select(_carried(keep).alias("carried"), quoted(text_col).alias("text"))
    kind = rows.schema["carried"].dataType.simpleString()
    out = arrow_map(rows, partial(_tree_batches, ranks=ranks), f"carried {kind}, text string, tree {TREE}")
    root = F.get("tree.tokens", F.lit(1)).cast("long")
    return out.select(*_put_back(keep), F.col("text").alias(text_col), "tree", root.alias("n_tokens"))


def _carried(keep: list[str]):
    """Columns that only travel along, by place: no name can clash with one of ours."""
    return F.struct(F.lit(0).alias("none"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(keep)])


def _put_back(keep: list[str]) -> list:
    return [F.col(f"carried.c{i}").alias(c) for i, c in enumerate(keep)]


def pattern_edits(text_col: str, rules: tuple[tuple[str, str], ...]):
    """A column of edits: the matches of each pattern with what takes their place. Of
    matches that overlap the first stays."""
    compiled = [(re.compile(pattern), put) for pattern, put in rules]

    def edits_of(text: str | None) -> list[dict]:
        found = [(m.start(), m.end(), put) for rule, put in compiled for m in rule.finditer(text or "")]
        out, free = [], 0
        for start, end, put in sorted(found):
            if start >= free:
                out.append({"start": start, "end": end, "text": put})
                free = max(end, start + 1)
        return out

    @F.pandas_udf("array<struct<start: int, end: int, text: string>>")
    def edits(texts: pd.Series) -> pd.Series:
        return texts.map(edits_of)

    return edits(quoted(text_col))


def _edit_batches(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    counter = _counter(ranks)
    for batch in batches:
        texts, trees, encoded = [], [], []
        held = batch.column(2)
        for i, (text, edits) in enumerate(zip(batch.column(1), batch.column(3))):
            text = text.as_py() or ""
            tree = np.stack([held.field(j)[i].values.to_numpy(zero_copy_only=False) for j in range(3)], axis=1)
            tree = tree.astype(np.int32)
            made = sorted((e["start"], e["end"], e["text"] or "") for e in edits.as_py() or [])
            text, tree, count = counter.edit(text, tree, made)
            texts.append(text)
            trees.append(tree)
            encoded.append(count)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), _tree_arrays(trees), pa.array(encoded, pa.int64())],
            names=["carried", "text", "tree", "n_encoded"],
        )


def apply_edits(
    counted: DataFrame, ranks: dict[bytes, int], edits_col: str = "edits", text_col: str = "text"
) -> DataFrame:
    """``counted`` (from ``count_tokens``) with the edits of each row made: ``text_col``,
    ``tree`` and ``n_tokens`` are new, ``n_encoded`` tells how many pre-tokens were
    encoded for it.

    ``edits_col`` is an array of ``(start, end, text)``, in code points of the text as it
    was and not overlapping; a null or empty array changes nothing."""
    keep = [c for c in counted.columns if c not in (text_col, "tree", "n_tokens", "n_encoded")]
    rows = counted.select(_carried(keep).alias("carried"), quoted(text_col).alias("text"), "tree", quoted(edits_col))
    kind = rows.schema["carried"].dataType.simpleString()
    out = arrow_map(
        rows, partial(_edit_batches, ranks=ranks), f"carried {kind}, text string, tree {TREE}, n_encoded long"
    )
    root = F.get("tree.tokens", F.lit(1)).cast("long")
    return out.select(*_put_back(keep), F.col("text").alias(text_col), "tree", root.alias("n_tokens"), "n_encoded")
