"""Elias-Fano coded sequences, and the levels of an n-gram model made of them, kept in files that are memory-mapped."""

from __future__ import annotations

import numpy as np
import pandas as pd

from lanemart.llm import mapped

#: Elements whose low bits are packed at a time; a multiple of 8, so that every part is whole bytes.
PACKED = 1 << 14


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place of each value among them."""
    codes, found = pd.factorize(values, sort=True)
    return found, codes


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted arrays."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(keys[0]), dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _numbered_in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``numbered`` for values that ascend already."""
    starts = runs(values)
    return values[starts], np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))


class EliasFano:
    """A non-decreasing sequence of 64-bit numbers: packed low bits, and one set bit per element above them.

    About ``2 + log2(universe / n)`` bits per element. ``successor`` finds the first element that is not below
    a value: the upper bits give the few elements that share its high part, and a binary search runs over the
    low bits of those.
    """

    def __init__(self, values: np.ndarray, universe: int):
        values = values.astype(np.uint64)
        self._shape(len(values), universe)
        shift, places = np.uint64(self.shift), np.arange(self.shift, dtype=np.uint64)
        low = values & ((np.uint64(1) << shift) - np.uint64(1))
        parts = (((low[k : k + PACKED, None] >> places) & np.uint64(1)).astype(np.uint8).ravel() for k in range(0, self.n, PACKED))
        packed = [np.packbits(p, bitorder="little") for p in parts]
        high = (values >> shift).astype(np.int64)
        upper = np.zeros(self.n + self.buckets, dtype=np.uint8)
        upper[high + np.arange(self.n)] = 1
        self.low, self.upper = np.concatenate([*packed, np.zeros(8, np.uint8)]), np.packbits(upper, bitorder="little")

    def _shape(self, n: int, universe: int) -> None:
        self.n, self.universe = n, universe
        self.shift = min(56, max(0, (universe // max(1, n)).bit_length() - 1))  # at most 8 bytes with any start
        self.buckets = int((universe - 1) >> self.shift) + 1 if universe else 1
        self.starts: np.ndarray | None = None

    @classmethod
    def laid(cls, n: int, universe: int, low: np.ndarray, upper: np.ndarray) -> EliasFano:
        """A sequence whose bits are there already."""
        out = cls.__new__(cls)
        out._shape(n, universe)
        out.low, out.upper = low, upper
        return out

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.shift:
            return np.zeros(len(at), dtype=np.uint64)
        bit = at.astype(np.int64) * self.shift
        eights = np.ndarray((len(self.low) - 7,), dtype="<u8", buffer=self.low, strides=(1,))  # 8 bytes from every byte on
        out = eights[bit >> 3] >> (bit & 7).astype(np.uint64)
        return out & ((np.uint64(1) << np.uint64(self.shift)) - np.uint64(1))

    def _bounds(self) -> np.ndarray:
        """Where each bucket of the high part begins: the ones before each zero of the upper bits."""
        if self.starts is None:
            zeros = np.flatnonzero(np.unpackbits(self.upper, count=self.n + self.buckets, bitorder="little") == 0)
            self.starts = np.concatenate(([0], zeros - np.arange(len(zeros))))
        return self.starts

    def access(self, at: np.ndarray) -> np.ndarray:
        """Elements by position."""
        high = np.searchsorted(self._bounds(), at, side="right") - 1
        return (high.astype(np.uint64) << np.uint64(self.shift)) | self._low(at)

    def _search(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position of the successor, end of the bucket of the high part, low part) of each value."""
        bounds, shift = self._bounds(), np.uint64(self.shift)
        high = np.minimum(values >> shift, np.uint64(self.buckets - 1)).astype(np.int64)
        low = values & ((np.uint64(1) << shift) - np.uint64(1))
        a, end = bounds[high], bounds[high + 1]
        b = end.copy()
        open_ = np.flatnonzero(a < b)
        while len(open_):
            mid = (a[open_] + b[open_]) >> 1
            less = self._low(mid) < low[open_]
            a[open_[less]] = mid[less] + 1
            b[open_[~less]] = mid[~less]
            open_ = open_[a[open_] < b[open_]]
        # Past the bucket's last element the successor is the first one of the next bucket, at the same position.
        return a, end, low

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Position of the first element not below each value, if it is below the universe; ``n`` where there is none."""
        return self._search(values.astype(np.uint64))[0]

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, -1 where it is not an element."""
        found = np.full(len(values), -1, dtype=np.int64)
        if not self.n or not len(values):
            return found
        values = values.astype(np.uint64)
        at, end, low = self._search(values)
        inside = np.flatnonzero((at < end) & (values <= np.uint64(self.universe - 1)))
        same = self._low(at[inside]) == low[inside]
        found[inside[same]] = at[inside[same]]
        return found


#: Logarithms are kept as 16-bit multiples of this power of two, from -16 to 16: the same value whatever else a shard holds, and
#: sums of such numbers are exact in doubles, in any order.
STEP = 2.0**-11


def quantised(values: np.ndarray) -> np.ndarray:
    """Codes of base-10 logarithms."""
    return np.rint(values / STEP).clip(-32768, 32767).astype(np.int16)


class Words:
    """How often the words of one shard occur in training, by their hashes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        self.least = int(hashes[0]) if len(hashes) else 0
        span = int(hashes[-1]) - self.least + 1 if len(hashes) else 1
        self.hashes, self.counts = EliasFano(hashes - np.uint64(self.least), span), counts.astype(np.int64)

    def save(self, path: str) -> None:
        head = {"least": self.least, "n": self.hashes.n, "universe": self.hashes.universe}
        mapped.write(path, head, {"low": self.hashes.low, "upper": self.hashes.upper, "counts": self.counts})

    @classmethod
    def open(cls, path: str) -> Words:
        head, arrays = mapped.read(path)
        out = cls.__new__(cls)
        out.least, out.counts = head["least"], arrays["counts"]
        out.hashes = EliasFano.laid(head["n"], head["universe"], arrays["low"], arrays["upper"])
        return out

    def count(self, hashes: np.ndarray, mask: int = (1 << 64) - 1) -> np.ndarray:
        """Counts of words; with a mask, of the first word whose hash has these bits under it."""
        out = np.zeros(len(hashes), dtype=np.int64)
        least = np.uint64(self.least)
        inside = np.flatnonzero((hashes | ~np.uint64(mask)) >= least)
        if not self.hashes.n or not len(inside):
            return out
        wanted = np.maximum(hashes[inside], least) - least
        fits = wanted < np.uint64(self.hashes.universe) if self.hashes.universe < 1 << 64 else np.ones(len(wanted), dtype=bool)
        inside, wanted = inside[fits], wanted[fits]
        at = self.hashes.successor(wanted)
        inside, at = inside[at < self.hashes.n], at[at < self.hashes.n]
        same = (self.hashes.access(at) + least) & np.uint64(mask) == hashes[inside]
        out[inside[same]] = self.counts[at[same]]
        return out


class Trie:
    """Smoothed probabilities of the trigrams whose middle word belongs to one shard.

    Levels, every one a monotone sequence because a child is stored as its parent's number times the number of
    possible children, plus its own:

    * ``words``: hashes of the words that come first in a bigram;
    * ``bigrams``: their successors; ``firsts`` points to where each word's successors begin;
    * ``contexts``: the words before them, one entry per context of two words;
    * ``trigrams``: for each context its successors, not as words but by their place among the successors of
      the context's second word, which makes the numbers small.

    Probabilities are absolutely discounted and stored in base-10 logarithms, quantised; so are the back-off
    weights of words and contexts. A trie is written to a file once and then read through a memory map.
    """

    LEVELS, CODES = ("vocabulary", "words", "bigrams", "firsts", "contexts", "trigrams"), ("p2", "p3", "back2", "back3")

    def __init__(self, words: np.ndarray, first: np.ndarray, before: np.ndarray, last: np.ndarray, counts: np.ndarray, discount: float):
        """From the distinct trigrams of the training texts, in the order of (first, before, last), and their counts; words
        go by their places among the ascending hashes ``words``."""
        self.vocabulary, self.size = EliasFano(words, 1 << 64), len(words) + 1
        heads, h = _numbered_in_order(first.astype(np.int64))
        self.words = EliasFano(words[heads], 1 << 64)
        b, w = before.astype(np.int64), last.astype(np.int64)

        pairs, pair_of = numbered(h * self.size + w)
        pair_count = np.bincount(pair_of, counts, len(pairs))
        pair_head = pairs // self.size
        head_count = np.bincount(pair_head, pair_count, len(heads))
        head_kinds = np.bincount(pair_head, minlength=len(heads))
        self.bigrams = EliasFano(pairs, len(heads) * self.size + 1)
        first_of = np.searchsorted(pair_head, np.arange(len(heads) + 1))
        self.firsts = EliasFano(first_of, len(pairs) + 1)
        p2 = (pair_count - discount) / head_count[pair_head]
        self.p2 = quantised(np.log10(p2))
        self.back2 = quantised(np.log10(discount * head_kinds / np.maximum(head_count, 1)))

        contexts, c = _numbered_in_order(h * self.size + b)
        self.contexts = EliasFano(contexts, len(heads) * self.size + 1)
        rank = pair_of - first_of[h]
        self.width = int(rank.max()) + 1 if len(rank) else 1
        grams = c * self.width + rank
        context_count = np.bincount(c, counts, len(contexts))
        context_kinds = np.bincount(c, minlength=len(contexts))
        self.trigrams = EliasFano(grams, len(contexts) * self.width + 1)
        self.p3 = quantised(np.log10((counts - discount) / context_count[c]))
        # What is left for the unseen words, over what the bigrams give them.
        seen = np.bincount(c, p2[pair_of], len(contexts))
        left = discount * context_kinds / np.maximum(context_count, 1)
        self.back3 = quantised(np.log10(left / np.maximum(1 - seen, 1e-9)))

    def save(self, path: str) -> None:
        levels = {n: getattr(self, n) for n in self.LEVELS}
        arrays = {f"{n}.{half}": getattr(level, half) for n, level in levels.items() for half in ("low", "upper")}
        head = {"size": self.size, "width": self.width, "levels": {n: [level.n, level.universe] for n, level in levels.items()}}
        mapped.write(path, head, arrays | {n: getattr(self, n) for n in self.CODES})

    @classmethod
    def open(cls, path: str) -> Trie:
        head, arrays = mapped.read(path)
        out = cls.__new__(cls)
        out.size, out.width = head["size"], head["width"]
        for n, (size, universe) in head["levels"].items():
            setattr(out, n, EliasFano.laid(size, universe, arrays[f"{n}.low"], arrays[f"{n}.upper"]))
        for n in cls.CODES:
            setattr(out, n, arrays[n])
        return out

    def query(self, words: np.ndarray, first: np.ndarray, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each trigram as far as it is known here, and whether the last word's own
        probability is still to be added. Words go by their places among the hashes ``words``."""
        out, open_ = np.zeros(len(first)), np.ones(len(first), dtype=bool)
        own, head = self.vocabulary.find(words), self.words.find(words)
        known = np.flatnonzero(head[first] >= 0)
        h, b, w = head[first[known]], own[before[known]], own[last[known]]

        def child(level: EliasFano, parent: np.ndarray, own: np.ndarray, size: int) -> np.ndarray:
            at = np.full(len(parent), -1, dtype=np.int64)
            both = np.flatnonzero((parent >= 0) & (own >= 0))
            at[both] = level.find(parent[both] * size + own[both])
            return at

        pair = child(self.bigrams, h, w, self.size)
        context = child(self.contexts, h, b, self.size)
        rank = np.where(pair >= 0, pair - self.firsts.access(h).astype(np.int64), -1)
        gram = child(self.trigrams, context, np.where(rank < self.width, rank, -1), self.width)
        value = self.back2[h].astype(np.int64)
        value[pair >= 0] = self.p2[pair[pair >= 0]]
        value[context >= 0] += self.back3[context[context >= 0]]
        value[gram >= 0] = self.p3[gram[gram >= 0]]
        out[known], open_[known] = value * STEP, pair < 0
        return out, open_
