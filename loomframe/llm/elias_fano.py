"""Monotone sequences in Elias and Fano's form, and a two-level n-gram trie made of them.

A sequence of n numbers below u takes about 2 + log2(u / n) bits a number: the low bits of each are packed at a fixed
width, the high bits are counted in unary. Everything is a flat array, so :meth:`Trie.save` and :meth:`Trie.load`
can use memory-mapped files, and a trie inside a task is read from the same arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class EliasFano:
    size: int
    low_bits: int
    lows: np.ndarray  # bytes, 8 more than needed
    highs: np.ndarray  # 64-bit words
    zeros: np.ndarray  # zeros before each of these words

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values``: not decreasing, unsigned, below ``universe``."""
        n = len(values)
        low = max(0, min(56, (universe // n).bit_length() - 1)) if n else 0
        values = values.astype(np.uint64)
        lows = np.zeros(0, np.uint8)
        if low and n:
            spread = (values[:, None] >> np.arange(low, dtype=np.uint64)).astype(np.uint8) & 1
            lows = np.packbits(spread.ravel(), bitorder="little")
        high = (values >> np.uint64(low)).astype(np.int64)
        length = (int(high[-1]) if n else 0) + n + 1
        flags = np.zeros(-(-length // 64) * 64, np.uint8)
        flags[high + np.arange(n)] = 1
        words = np.packbits(flags, bitorder="little").view(np.uint64)
        zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))])
        return cls(n, low, np.concatenate([lows, np.zeros(8, np.uint8)]), words, zeros)

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at.astype(np.int64) * self.low_bits
        byte = bit >> 3
        value = np.zeros(len(at), np.uint64)
        for k in range(8):
            value |= self.lows[byte + k].astype(np.uint64) << np.uint64(8 * k)
        return (value >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def _zero(self, rank: np.ndarray) -> np.ndarray:
        """The place of the zero with this rank (select)."""
        word = np.searchsorted(self.zeros, rank, "right") - 1
        left = rank - self.zeros[word]
        bits = ~self.highs[word]
        place = np.zeros(len(rank), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            part = np.bitwise_count((bits >> place.astype(np.uint64)) & np.uint64((1 << step) - 1)).astype(np.int64)
            over = left >= part
            left = np.where(over, left - part, left)
            place = np.where(over, place + step, place)
        return word * 64 + place

    def successor(self, values: np.ndarray) -> np.ndarray:
        """For each value the place of the first member that is not below it; ``size`` if there is none."""
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        most = int(self.zeros[-1])
        inside = high < most
        known = np.where(inside, high, 0)
        end = np.where(inside, self._zero(np.minimum(known, most - 1)) - known, self.size)
        before = np.maximum(known - 1, 0)
        begin = np.where(inside, np.where(known > 0, self._zero(before) - before, 0), self.size)
        begin, end = np.minimum(begin, self.size), np.minimum(end, self.size)
        target = values & np.uint64((1 << self.low_bits) - 1)
        while True:  # halve the members with the same high bits
            open_ = np.flatnonzero(begin < end)
            if not len(open_):
                return begin
            middle = (begin[open_] + end[open_]) // 2
            below = self._low(middle) < target[open_]
            begin[open_] = np.where(below, middle + 1, begin[open_])
            end[open_] = np.where(below, end[open_], middle)

    def values(self, at: np.ndarray) -> np.ndarray:
        """The members at these places."""
        flags = np.flatnonzero(np.unpackbits(self.highs.view(np.uint8), bitorder="little"))[: self.size]
        high = (flags - np.arange(self.size)).astype(np.uint64)
        return (high[at] << np.uint64(self.low_bits)) | self._low(at)

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.head": np.array([self.size, self.low_bits]), f"{name}.lows": self.lows, f"{name}.highs": self.highs, f"{name}.zeros": self.zeros}

    @classmethod
    def from_arrays(cls, arrays, name: str) -> EliasFano:
        size, low = (int(x) for x in arrays[f"{name}.head"])
        return cls(size, low, arrays[f"{name}.lows"], arrays[f"{name}.highs"], arrays[f"{name}.zeros"])


#: Codes of log10 probabilities: 1 is about -13, 65535 is 0, rounded down; 0 is no entry.
STEP = 13 / 65534


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(log10 / STEP) + 65535, 1, 65535).astype(np.uint16)


def dequantised(codes: np.ndarray) -> np.ndarray:
    """Probabilities; 0 where there is no entry."""
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 65535) * STEP), 0.0)


@dataclass
class Trie:
    """Contexts on the first level, the words that follow each on the second.

    Words get numbers among the followers of this trie. The number of a follower is made relative to its context by
    adding context times the number of words, which makes the whole level one monotone sequence; pointers tell
    where a context's followers begin in it.
    """

    contexts: EliasFano
    words: EliasFano
    pointers: EliasFano
    followers: EliasFano
    backoff: np.ndarray  # codes of what a context leaves to single words
    share: np.ndarray  # codes of the followers' own part of the probability

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, share: np.ndarray, backoff: np.ndarray, bits: int = 48) -> Trie:
        """From distinct pairs, sorted by context and word; ``backoff`` has one entry per distinct context."""
        contexts, rank = np.unique(context, return_inverse=True)
        words, number = np.unique(word, return_inverse=True)
        begin = np.append(np.searchsorted(rank, np.arange(len(contexts))), len(rank))
        level = rank.astype(np.uint64) * np.uint64(max(1, len(words))) + number.astype(np.uint64)
        return cls(
            EliasFano.of(contexts, 1 << 64),
            EliasFano.of(words, 1 << bits),
            EliasFano.of(begin, len(rank) + 1),
            EliasFano.of(level, max(1, len(contexts) * len(words))),
            quantised(np.log10(backoff)),
            quantised(np.log10(share)),
        )

    @staticmethod
    def _find(sequence: EliasFano, members: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = sequence.successor(wanted)
        inside = place < sequence.size
        hit = np.zeros(len(wanted), bool)
        hit[inside] = members[place[inside]] == wanted[inside]
        return place, hit

    def look_up(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each pair, 0 for unknown ones."""
        out = np.zeros(len(context), np.uint16)
        if not self.followers.size or not len(context):
            return out
        every = np.arange
        i, known = self._find(self.contexts, self.contexts.values(every(self.contexts.size)), context)
        j, heard = self._find(self.words, self.words.values(every(self.words.size)), word)
        both = np.flatnonzero(known & heard)
        wanted = i[both].astype(np.uint64) * np.uint64(self.words.size) + j[both].astype(np.uint64)
        level = self.followers.values(every(self.followers.size))
        place, hit = self._find(self.followers, level, wanted)
        out[both[hit]] = self.share[place[hit]]
        return out

    def followers_of(self, context: int) -> tuple[np.ndarray, np.ndarray]:
        """``(words, codes)`` that follow a context, by its pointers."""
        place, hit = self._find(self.contexts, self.contexts.values(np.arange(self.contexts.size)), np.array([context], np.uint64))
        if not hit[0]:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
        begin, end = self.pointers.values(place[0] + np.arange(2)).astype(np.int64)
        at = np.arange(begin, end)
        return self.words.values((self.followers.values(at) - np.uint64(place[0] * self.words.size)).astype(np.int64)), self.share[at]

    def save(self, path: str) -> None:
        """Write the levels as one file per array below a folder, for :meth:`load`."""
        import os

        os.makedirs(path, exist_ok=True)
        for name in ("contexts", "words", "pointers", "followers"):
            for key, array in getattr(self, name).arrays(name).items():
                np.save(os.path.join(path, key + ".npy"), array)
        np.save(os.path.join(path, "backoff.npy"), self.backoff)
        np.save(os.path.join(path, "share.npy"), self.share)

    @classmethod
    def load(cls, path: str) -> Trie:
        """Map a saved trie's arrays into memory."""
        import os

        class Mapped:
            def __getitem__(self, key: str) -> np.ndarray:
                return np.load(os.path.join(path, key + ".npy"), mmap_mode="r")

        arrays = Mapped()
        levels = [EliasFano.from_arrays(arrays, name) for name in ("contexts", "words", "pointers", "followers")]
        return cls(*levels, arrays["backoff"], arrays["share"])
