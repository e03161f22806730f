"""Byte-level BPE by batched merge rounds in numpy.

A text is cut into stretches at places where no token can cross (before a run of white space, and before the last
character of one that a word follows), stretches that a worker has met are taken from memory, and the pieces of all
others lie behind one another in one flat array of symbols. A round finds every piece's pair of the lowest rank, by a
binary search over the sorted pair keys, and merges it wherever it stands in that piece; pieces without a known pair
leave the array. A pair that a merge makes has a higher rank than the merge itself, so rounds give what merging one
pair at a time gives.

Null texts are encoded like empty ones: no ids. Marks of special tokens in a text become those tokens, as in the
tokenizers library by default. Bytes that are not UTF-8 are read as U+FFFD. Repeated rows and ids are coded row by row;
other columns of the input are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.words import Memory, _hashes, binary_parts, gathered, sliced, texts_of

#: What a pair without a merge ranks as.
NEVER = np.iinfo(np.int64).max
#: Bytes that are cut, hashed or merged at a time.
STRETCH = 1 << 18
#: Longer stretches are encoded each time they occur.
LONG = 1 << 12
#: The pre-tokenizer's pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space beyond ASCII, in UTF-8 (fixed values).
WIDE_SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary: itself if printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


def space_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, sizes in bytes)`` of the white-space characters in UTF-8 bytes, ascending."""
    ascii_spaces = np.flatnonzero((data == 32) | ((data >= 9) & (data <= 13)))
    places, sizes = [ascii_spaces], [np.ones(len(ascii_spaces), np.int64)]
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(data == lead)
        for space in WIDE_SPACES:
            if space[0] == lead and len(at):
                fits = at[at + len(space) <= len(data)]
                for k, byte in enumerate(space[1:], 1):
                    fits = fits[data[fits + k] == byte]
                places.append(fits)
                sizes.append(np.full(len(fits), len(space), np.int64))
    flat, many = np.concatenate(places), np.concatenate(sizes)
    order = np.argsort(flat, kind="stable")
    return flat[order], many[order]


def stretches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the stretches begin that are encoded on their own; every text that is not empty begins one."""
    at, size = space_starts(data)
    begins = offsets[:-1][np.diff(offsets) > 0]
    if not len(at):
        return begins
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = np.ones(len(at), bool)
    opens[1:] = (at[1:] != at[:-1] + size[:-1]) | edge[at[1:]]
    closes = np.append(opens[1:], True) & ~edge[at + size]
    return np.unique(np.concatenate([begins, at[opens], at[closes]]))


class Codec:
    """Encodes and decodes with a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, first = spec["model"], spec.get("pre_tokenizer") or {}
        unused = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")]
        if model["type"] != "BPE" or first.get("type") != "ByteLevel" or not first.get("use_regex", True) or first.get("add_prefix_space"):
            raise ValueError(f"{path} is no byte-level BPE without a prefix space")
        if any(unused) or spec.get("normalizer") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} uses options that byte-level BPE has no need of")
        vocab = model["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *special.values()]) + 1
        self.tokens = [b""] * self.size
        for token, i in vocab.items():
            self.tokens[i] = bytes(byte_of[c] for c in token)
        for token, i in special.items():
            self.tokens[i] = token.encode()
        self.special = {t.encode(): i for t, i in special.items()}
        self.marks = regex.compile(b"|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if special else None
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        if len(np.unique(merged)) != len(merged) or (np.maximum(_made(merged, left), _made(merged, right)) >= np.arange(len(pairs))).any():
            raise ValueError(f"{path} has merges that come before those they build on")
        keys = left * self.size + right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys, self.merged = keys[self.rank_of], merged
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        self.words, self.cut = regex.compile(PATTERN), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.known = Memory(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of symbols."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NEVER)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, number of ids of each piece)`` of pieces of ``sizes`` symbols (none 0) that lie behind one another."""
        piece = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbols), NEVER)
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(symbols))))
            done = best == NEVER
            if done.any():
                ready.append((piece[done], symbols[done]))
                symbols, piece, rank, best = (x[~done] for x in (symbols, piece, rank, best))
            at = np.flatnonzero(rank == best)
            if not len(at):
                break
            run = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1))
            at = at[(at - np.repeat(at[run], np.diff(np.append(run, len(at))))) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            left = np.ones(len(symbols), bool)
            left[at + 1] = False
            symbols, piece, rank = symbols[left], piece[left], rank[left]
            at = at - np.arange(len(at))
            changed = np.union1d(at, at[at > 0] - 1)
            inside = (changed + 1 < len(symbols)) & (piece[changed] == piece[np.minimum(changed + 1, len(symbols) - 1)])
            rank[changed] = NEVER
            changed = changed[inside]
            rank[changed] = self.ranks(symbols[changed], symbols[changed + 1])
        if not ready:
            return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
        piece, symbols = (np.concatenate(x) for x in zip(*ready))
        return symbols[np.argsort(piece, kind="stable")].astype(np.int32), np.bincount(piece, minlength=len(sizes))

    def pieces(self, stretch: bytes) -> list[bytes]:
        """What the pre-tokenizer makes of a stretch."""
        text = stretch.decode("utf-8", "replace")
        if text.isascii():
            return [p.encode() for p in self.words.findall(text)]
        return [text[a:b].encode() for _, (a, b) in self.cut(text)]

    def encode_stretches(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, number of ids of each)``; equal pieces are merged once."""
        number: dict[bytes, int] = {}
        places, counts = [], []
        for text in texts:
            found = self.pieces(text)
            counts.append(len(found))
            places += [number.setdefault(p, len(number)) for p in found]
        distinct, flat, sizes, at = list(number), [], [], 0
        while at < len(distinct):
            to, total = at, 0
            while to < len(distinct) and (to == at or total + len(distinct[to]) <= STRETCH):
                total += len(distinct[to])
                to += 1
            symbols = self.byte_ids[np.frombuffer(b"".join(distinct[at:to]), np.uint8)]
            ids, size = self.merge(symbols, np.array([len(p) for p in distinct[at:to]]))
            flat.append(ids)
            sizes.append(size)
            at = to
        if not flat:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ids, size = np.concatenate(flat), np.concatenate(sizes)
        which = np.array(places, np.int64)
        out, _ = gathered(ids, (np.cumsum(size) - size)[which], size[which])
        ends = np.concatenate([[0], np.cumsum(size[which])])[np.concatenate([[0], np.cumsum(counts)])]
        return out, np.diff(ends)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each text of UTF-8 bytes."""
        raw = data.tobytes()
        bounds, special = offsets, {}
        if self.marks is not None:
            found = [(m.start(), m.end(), self.special[m.group()]) for a, b in zip(offsets.tolist(), offsets[1:].tolist()) for m in self.marks.finditer(raw, a, b)]
            special = {a: i for a, _, i in found}
            bounds = np.unique(np.concatenate([offsets, np.array([x for f in found for x in f[:2]], np.int64)]))
        starts = stretches(data, bounds)
        ends = np.append(starts[1:], len(data))
        sizes = np.zeros(len(starts), np.int64)
        parts: list[np.ndarray] = []
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + STRETCH, "right")))
            flat, size = self._some(raw, data, starts[at:to], ends[at:to], special)
            parts.append(flat)
            sizes[at:to] = size
            at = to
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)].tolist()
        return [flat[a:b] for a, b in zip(edges, edges[1:])]

    def _some(self, raw: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, special: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a few stretches: marks of special tokens, long ones, and those that may be remembered."""
        alone = ends - starts > LONG
        if special:
            alone |= np.isin(starts, np.fromiter(special, np.int64))
        rest = np.flatnonzero(~alone)
        hashes, first, number = np.unique(_hashes(data, starts[rest], ends[rest], False), return_index=True, return_inverse=True)
        a, b = starts[rest][first], ends[rest][first]
        new = lambda w: self.encode_stretches([raw[x:y] for x, y in zip(a[w].tolist(), b[w].tolist())])
        begin, size = self.known.look_up(hashes, new)
        flat, many = self.known.flat, np.zeros(len(starts), np.int64)
        if not alone.any():
            return gathered(flat, begin[number], size[number])[0], size[number]
        where = np.zeros(len(starts), np.int64)
        where[rest], many[rest] = begin[number], size[number]
        for k in np.flatnonzero(alone).tolist():
            at = int(starts[k])
            ids = np.array([special[at]], np.int32) if at in special else self.encode_stretches([raw[at : int(ends[k])]])[0]
            where[k], many[k] = len(flat), len(ids)
            flat = np.concatenate([flat, ids])
        return gathered(flat, where, many)[0], many

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids; ids beyond the vocabulary are left out, what is no UTF-8 is U+FFFD."""
        inside = ids[(ids >= 0) & (ids < self.size)]
        return b"".join(map(self.tokens.__getitem__, inside.tolist())).decode("utf-8", "replace")


def _made(merged: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The rank of the merge that makes each symbol, -1 of a single byte."""
    order = np.argsort(merged)
    at = np.minimum(np.searchsorted(merged[order], part), len(merged) - 1)
    return np.where(merged[order][at] == part, order[at], -1)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """This worker's codec for a file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in sliced(batches):
            yield pa.record_batch([batch.column("id"), _lists(tool.encode(*binary_parts(batch.column("text"))))], ["id", "ids"])

    rows = texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "id bigint, ids array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """``(id, ids, text)`` from ``(id, ids)``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, none = codec(path), np.zeros(0, np.int32)
        for batch in sliced(batches):
            ids = batch.column("ids")
            texts = [tool.decode(x.values.drop_null().to_numpy() if x.is_valid else none) for x in ids]
            yield pa.record_batch([batch.column("id"), ids, pa.array(texts, pa.string())], ["id", "ids", "text"])

    rows = tokens.select(F.col("id").cast("long").alias("id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "id bigint, ids array<int>, text string")
