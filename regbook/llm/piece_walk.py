"""The forward pass of BPE pieces over many sorted words at once.

The sorted words are the depth-first order of their trie. All words take their next
character together; those that are like the word before them so far share its state, and
only the others, the new nodes of the trie, compute one. The state is the last piece of a
prefix. The pieces that end at a character come from an Aho-Corasick automaton over the
pieces, longest first; the first one that stays apart from the piece before it is it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Answers on pairs of pieces that a worker keeps, as a power of two.
ANSWERS = 18
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.view(np.uint64) * SPREAD) >> np.uint64(64 - bits)).view(np.int64)


class PairTable:
    """A number for each of given pairs, kept under a hash of the pair."""

    def __init__(self, lefts: list[int], rights: list[int], values: list[int], width: int):
        self.width = width
        self.bits = max(4, (4 * len(values)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        wanted = np.array(lefts, np.int64) * width + np.array(rights, np.int64)
        slots, todo = _slots(wanted, self.bits), np.arange(len(wanted))
        while len(todo):
            free = todo[self.keys[slots[todo]] < 0]
            self.keys[slots[free]] = wanted[free]
            # Of several that met at a free slot the last has got it.
            placed = self.keys[slots[todo]] == wanted[todo]
            self.values[slots[todo[placed]]] = np.array(values, np.int32)[todo[placed]]
            todo = todo[~placed]
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The numbers of the pairs, -1 for none."""
        wanted = left.astype(np.int64) * self.width + right
        slots = _slots(wanted, self.bits)
        there = self.keys[slots]
        found = np.where(there == wanted, self.values[slots], np.int32(-1))
        todo = np.flatnonzero((there != wanted) & (there >= 0))
        while len(todo):
            at = slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)
            there = self.keys[at]
            hit = there == wanted[todo]
            found[todo[hit]] = self.values[at[hit]]
            todo = todo[~hit & (there >= 0)]
        return found


class Walk:
    """``stable`` are the pieces that BPE makes of themselves, ``made`` tells what the joined
    strings within them were joined from; ``ids`` and ``scores`` are those of all pieces."""

    def __init__(
        self,
        ids: dict[str, int],
        scores: list[float],
        stable: list[str],
        made: dict[str, tuple[str, str]],
        byte_ids: dict[int, int],
    ):
        count = len(scores)
        # Single characters inside pieces that are no pieces have numbers after all others.
        singles = sorted({c for p in ids for c in p} - ids.keys())
        symbols = ids | {c: count + i for i, c in enumerate(singles)}
        self.count, self.byte_ids = count, byte_ids
        self.scores = np.full(count + len(singles), -np.inf)
        self.scores[:count] = scores
        self.sizes = np.ones(count, np.int64)
        self.first = np.full(count + len(singles), -1, np.int32)
        self.second = self.first.copy()
        for piece in stable:
            self.sizes[ids[piece]] = len(piece)
        for piece, (first, second) in made.items():
            self.first[ids[piece]], self.second[ids[piece]] = symbols[first], symbols[second]
        joined = [
            (symbols[p[:k]], symbols[p[k:]], i)
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        ]
        self.joined = PairTable(*(list(c) for c in zip(*joined)) if joined else ([], [], []), width=len(self.scores))
        self._automaton({p: ids[p] for p in stable})
        self.asked = np.full(1 << ANSWERS, -1, np.int64)
        self.answers = np.zeros(1 << ANSWERS, bool)

    def _automaton(self, pieces: dict[str, int]) -> None:
        nodes = {"": 0}
        for piece in pieces:
            for end in range(1, len(piece) + 1):
                nodes.setdefault(piece[:end], len(nodes))
        letters = {c: i + 1 for i, c in enumerate(sorted({c for p in pieces for c in p}))}
        # The class of each character; 0 is in no piece.
        self.letters = np.zeros(0x110000, np.uint16 if len(letters) < 65535 else np.int32)
        for letter, number in letters.items():
            self.letters[ord(letter)] = number
        grown = [p for p in nodes if p]
        self.next = PairTable(
            [nodes[p[:-1]] for p in grown], [letters[p[-1]] for p in grown], [nodes[p] for p in grown], len(letters) + 1
        )
        # By node: the longest shorter node that it ends in, the piece it is (or -1), the
        # longest node that is a piece among itself and those it ends in, and after that.
        self.fail = np.zeros(len(nodes), np.int32)
        self.piece = np.full(len(nodes), -1, np.int32)
        self.longest = np.zeros(len(nodes), np.int32)
        self.shorter = np.zeros(len(nodes), np.int32)
        for text in sorted(grown, key=len):
            node = nodes[text]
            fail = self.fail[node] = next(nodes[text[k:]] for k in range(1, len(text) + 1) if text[k:] in nodes)
            self.piece[node] = pieces.get(text, -1)
            self.shorter[node] = self.longest[fail]
            self.longest[node] = node if text in pieces else self.longest[fail]

    def _step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        found = self.next.get(node, letter)
        todo = np.flatnonzero(found < 0)
        node = node[todo]
        while len(todo):
            # The root takes every character.
            found[todo[node == 0]] = 0
            todo, node = todo[node > 0], self.fail[node[node > 0]]
            found[todo] = self.next.get(node, letter[todo])
            missing = found[todo] < 0
            todo, node = todo[missing], node[missing]
        return found

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether no pair across the border of two pieces is ever the best one. Both pieces
        are unmade from the end, the one made later first (of equals the right one, since
        the left one is joined first); what stands at the border in between must not join
        before what was unmade."""
        result = np.ones(len(left), bool)
        todo = np.arange(len(left))
        # A pair across joins first if it is better than this, or as good and to its left.
        bound, also_equal = np.full(len(left), -np.inf), np.ones(len(left), bool)
        while len(todo):
            across = self.joined.get(left, right)
            score = self.scores[across]
            joins = (across >= 0) & ((score > bound) | also_equal & (score == bound))
            result[todo[joins]] = False
            on = ~joins & ((self.first[left] >= 0) | (self.first[right] >= 0))
            todo, left, right = todo[on], left[on], right[on]
            score_left, score_right = self.scores[left], self.scores[right]
            of_left = (self.first[right] < 0) | (self.first[left] >= 0) & (score_left < score_right)
            bound, also_equal = np.where(of_left, score_left, score_right), ~of_left
            left, right = np.where(of_left, self.second[left], left), np.where(of_left, right, self.first[right])
        return result

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``apart``, remembered by pair."""
        keys = left.astype(np.int64) * self.count + right
        slots = _slots(keys, ANSWERS)
        found = self.answers[slots]
        todo = np.flatnonzero(self.asked[slots] != keys)
        if len(todo):
            new, of = np.unique(keys[todo], return_inverse=True)
            told = self.apart((new // self.count).astype(np.int32), (new % self.count).astype(np.int32))
            found[todo] = told[of]
            # Of several that share a slot the last stays, in both tables.
            at = _slots(new, ANSWERS)
            self.asked[at], self.answers[at] = new, told
        return found

    def _last_pieces(self, codes: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each character the last piece of the word up to it, -1 if it is in none."""
        last = np.empty(len(codes), np.int32)
        places, left = at.copy(), sizes.copy()
        node = np.zeros(len(at), np.int32)
        # Words are like the word before them so far, which stands beside them.
        alike = np.ones(len(at), bool)
        depth = 0
        while len(places):
            here = codes[places]
            alike[0] = False
            alike[1:] &= here[1:] == here[:-1]
            new = np.flatnonzero(~alike)
            node_new = self._step(node[new], self.letters[here[new]])
            found = self._choose(last, places[new], node_new, depth)
            owner = np.cumsum(~alike) - 1
            last[places] = found[owner]
            node = node_new[owner]
            depth += 1
            on = left > depth
            # A word whose neighbour ends here is new from the next character on.
            alike[1:] &= on[:-1]
            places, left, node, alike = places[on] + 1, left[on], node[on], alike[on]
        return last

    def _choose(self, last: np.ndarray, places: np.ndarray, node: np.ndarray, depth: int) -> np.ndarray:
        found = np.full(len(places), -1, np.int32)
        node = self.longest[node]
        todo = np.flatnonzero(node)
        node = node[todo]
        while len(todo):
            piece = self.piece[node]
            size = self.sizes[piece]
            # Nothing merges with a character that has no piece.
            before = np.where(size > depth, np.int32(-1), last[places[todo] - size])
            fits = before < 0
            ask = np.flatnonzero(~fits)
            fits[ask] = self._fit(before[ask], piece[ask])
            found[todo[fits]] = piece[fits]
            todo, node = todo[~fits], self.shorter[node[~fits]]
            todo, node = todo[node > 0], node[node > 0]
        return found

    def encode(self, words: pa.StringArray) -> pa.ListArray:
        """Piece numbers of sorted distinct words, none of them empty."""
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        bounds = chars[ends - ends[0]]
        at, sizes = bounds[:-1], np.diff(bounds)
        last = self._last_pieces(codes, at, sizes)
        # From the ends of all words back to their starts.
        rounds, counts = [], np.zeros(len(words), np.int64)
        word, place = np.arange(len(words)), bounds[1:] - 1
        while len(word):
            piece = last[place]
            known = piece >= 0
            rounds.append((word, np.where(known, piece, ~codes[place].astype(np.int32))))
            counts[word] += 1
            place = place - np.where(known, self.sizes[piece], 1)
            on = place >= at[word]
            word, place = word[on], place[on]
        ends = np.cumsum(counts)
        pieces = np.empty(ends[-1] if len(ends) else 0, np.int32)
        for number, (word, piece) in enumerate(rounds):
            pieces[ends[word] - 1 - number] = piece
        pieces, ends = self._with_bytes(pieces, ends)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(pieces))

    def _with_bytes(self, pieces: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece, given as their complement, become their bytes."""
        at = np.flatnonzero(pieces < 0)
        if not len(at):
            return pieces, ends
        codes, of = np.unique(~pieces[at], return_inverse=True)
        texts = [chr(c).encode() for c in codes]
        sizes = np.ones(len(pieces), np.int64)
        sizes[at] = np.array([len(t) for t in texts])[of]
        stops = np.cumsum(sizes)
        spread = np.repeat(pieces, sizes)
        for k in range(4):
            byte = np.array([self.byte_ids.get(t[k], 0) if k < len(t) else -1 for t in texts], np.int32)[of]
            there = byte >= 0
            spread[(stops - sizes)[at[there]] + k] = byte[there]
        return spread, stops[ends - 1]
