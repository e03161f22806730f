"""Words and word shingles of whole Arrow batches, hashed in vectorised numpy.

A word is a longest run of bytes other than space and the controls 9 to 13. Words are identified by a 64-bit
multilinear hash of their bytes, shingles by a 64-bit hash of their words' hashes; two different ones among a billion
collide with a probability of about 3 in 100.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes handled at a time; temporary arrays take about 40 times as much.
CHUNK = 1 << 17
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _random.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = _random.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of each value over all bits of the result; one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9FB21C651E98DF25)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a binary column; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, b"")
    wide = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def joined_parts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same of a list of byte strings."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def _cuts(data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about CHUNK bytes that cut no word."""
    at, ends = 0, offsets
    while at < len(data):
        to = min(at + CHUNK, len(data))
        if to < len(data):
            k = int(np.searchsorted(ends, to, "right")) - 1
            if ends[k] > at:
                to = int(ends[k])
            else:  # inside one long text: cut behind a space
                while to < len(data):
                    gap = np.flatnonzero(spaces[data[to : to + CHUNK]])
                    to = min(to + (int(gap[0]) + 1 if len(gap) else CHUNK), len(data))
                    if len(gap):
                        break
                to = min(to, int(ends[k + 1]))
        yield at, to
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray = SPACES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(starts, ends)`` of the words, a stretch at a time, as places in ``data``."""
    for at, to in _cuts(data, offsets, spaces):
        word = ~spaces[data[at:to]]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        edge = np.unique(offsets[(offsets > at) & (offsets < to)]) - at
        first[edge] = word[edge]
        last[edge - 1] = word[edge - 1]
        yield np.flatnonzero(first) + at, np.flatnonzero(last) + at + 1


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    sizes = ends - starts
    if not len(sizes):
        return np.zeros(0, np.uint64)
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    letters = data[place + np.repeat(starts, sizes)]
    if lower:
        letters = LOWER[letters]
    value = _BYTE[letters] * _PLACE[place & 4095]
    if int(sizes.max()) > 4096:
        value *= _BLOCK[(place >> 12) & 4095]
    return mix(np.add.reduceat(value, first) + sizes.astype(np.uint64) * _STEP[0])


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes of all words in order, number of words of each text)``."""
    found, begun = [], []
    for starts, ends in word_spans(data, offsets):
        found.append(_hashes(data, starts, ends, lower))
        begun.append(starts)
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    starts = np.concatenate(begun) if begun else np.zeros(0, np.int64)
    return hashes, np.diff(np.searchsorted(starts, offsets))


def distinct_words(data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, starts and ends of the distinct words, the number of each word in order, words of each text)``.

    Letters stay as they are.
    """
    spans = list(word_spans(data, offsets, spaces))
    none = np.zeros(0, np.int64)
    if not spans:
        return none.astype(np.uint64), none, none, none, np.zeros(len(offsets) - 1, np.int64)
    hashes = np.concatenate([_hashes(data, s, e, False) for s, e in spans])
    starts, ends = (np.concatenate(x) for x in zip(*spans))
    found, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    return found, starts[first], ends[first], number, np.diff(np.searchsorted(starts, offsets))


class Memory:
    """Arrays that a Python worker has computed, by 64-bit hashes of what they come from.

    Beyond ``most`` entries all are forgotten, which changes no result.
    """

    def __init__(self, kind: type, most: int = 1_000_000):
        self.kind, self.most = kind, most
        self.forget()

    def forget(self) -> None:
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.kind)

    def look_up(self, hashes: np.ndarray, compute) -> tuple[np.ndarray, np.ndarray]:
        """``(begin, size)`` in :attr:`flat` for sorted distinct hashes; ``compute(which) -> (flat, sizes)`` of new ones."""
        if len(self.keys) > self.most:
            self.forget()
        place = np.searchsorted(self.keys, hashes)
        new = np.ones(len(hashes), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != hashes[inside]
        if new.any():
            flat, sizes = compute(np.flatnonzero(new))
            at = place[new]
            self.begin = np.insert(self.begin, at, len(self.flat) + np.cumsum(sizes) - sizes)
            self.size = np.insert(self.size, at, sizes)
            self.keys = np.insert(self.keys, at, hashes[new])
            self.flat = np.concatenate([self.flat, flat])
            place = np.searchsorted(self.keys, hashes)
        return self.begin[place], self.size[place]


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(the given stretches of flat one behind the other, where each ends)``."""
    ends = np.cumsum(size)
    return flat[np.arange(int(size.sum())) + np.repeat(begin - ends + size, size)], ends


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes of all runs of that many words, number of them of each text)``.

    A text of fewer words has its whole sequence as its one shingle, a text without words has none.
    """
    counts = counts.astype(np.int64)
    sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    runs = np.minimum(counts, words)
    begins = np.cumsum(counts) - counts
    rank = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at, run = rank + np.repeat(begins, sizes), np.repeat(runs, sizes)
    value = run.astype(np.uint64) * _STEP[1]
    for k in range(words):
        has = run > k
        if has.all():
            value = mix(value + hashes[at + k] * _STEP[2 + k % 62])
        else:
            value[has] = mix(value[has] + hashes[at[has] + k] * _STEP[2 + k % 62])
    return value, sizes


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; letters A to Z in lower case."""
    value, sizes = shingle_hashes(*word_hashes(data, offsets), words)
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        yield np.unique(value[a:b])


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, for work that takes many times a batch's bytes."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def as_bytes(text: str | Column) -> Column:
    """A text column's UTF-8 bytes, to send to Python."""
    return (F.col(text) if isinstance(text, str) else text).cast("string").cast("binary")


def texts_of(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``(id, text as bytes, ...)`` under fixed names, so that no other column can clash."""
    return docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"), *more)
