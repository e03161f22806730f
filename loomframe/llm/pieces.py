"""SentencePiece models, encoded and decoded by the tokenizers library.

The model's protobuf is parsed here, and its normaliser, space marker, scores (unigram) or merges (BPE) and byte
fallback are rebuilt as a tokenizer. Where no piece reaches over a space, a text is encoded space by space, and a
worker encodes each stretch that it has not met before; batches use all the threads the library is given.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.words import _hashes, Memory, as_bytes, binary_parts, distinct_words, gathered, joined_parts, texts_of

SPACE = "\N{LOWER ONE EIGHTH BLOCK}"
# Kinds of pieces and of models in the protobuf.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
ONLY_SPACE = np.zeros(256, bool)
ONLY_SPACE[32] = True


def protobuf(data: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """``(field, value)`` of a message, in order."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, data[at : at + size]
            at += size
        elif wire == 5:
            yield number, struct.unpack_from("<f", data, at)[0]
            at += 4
        else:
            yield number, struct.unpack_from("<d", data, at)[0]
            at += 8


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def load(cls, path: str) -> Model:
        """Read a model file, which lies with the library's other installed files."""
        model = cls()
        with open(path, "rb") as file:
            fields = list(protobuf(file.read()))
        for number, value in fields:
            if number == 1:
                piece = dict(protobuf(value))
                model.pieces.append((piece[1].decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(protobuf(value))
                model.kind, model.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                rule = dict(protobuf(value))
                model.charsmap = rule.get(2, b"")
                model.dummy_prefix, model.squeeze, model.escape = (bool(rule.get(k, 1)) for k in (3, 4, 5))
        return model

    @property
    def by_space(self) -> bool:
        """Whether stretches between single spaces can be encoded one by one."""
        ahead = all(SPACE not in p.lstrip(SPACE) for p, _, kind in self.pieces if kind in (NORMAL, USER, UNUSED))
        return self.kind == BPE and ahead and not self.charsmap and not self.squeeze and self.dummy_prefix and self.escape

    def tokenizer(self):
        """The model as a tokenizer of the tokenizers library."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        number = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), None)
        if self.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=unknown, byte_fallback=self.byte_fallback)
        elif self.kind == BPE:
            merges = []
            for piece, _, kind in sorted(self.pieces, key=lambda p: -p[1]):
                if kind == NORMAL:
                    halves = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
                    merges += sorted((h for h in halves if h[0] in number and h[1] in number), key=lambda h: (number[h[0]], number[h[1]]))
            name = self.pieces[unknown][0] if unknown is not None else None
            core = models.BPE(vocab=number, merges=merges, unk_token=name, fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            raise ValueError(f"models of kind {self.kind} are not supported")
        tool = Tokenizer(core)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(SPACE if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", SPACE))
        tool.normalizer = normalizers.Sequence(steps)
        tool.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()])
        own = [AddedToken(p, normalized=False) for p, _, kind in self.pieces if kind == USER]
        if own:
            tool.add_tokens(own)
        return tool


class Codec:
    """Encoding and decoding with one model, in one Python worker."""

    def __init__(self, path: str):
        self.model = Model.load(path)
        self.tool = self.model.tokenizer()
        self.by_space = self.model.by_space
        self.known, self.read = Memory(np.int32, 500_000), Memory(np.uint8, 500_000)
        kinds = np.array([kind for _, _, kind in self.model.pieces])
        self.is_byte = kinds == BYTE
        self.opens = np.array([p.startswith(SPACE) for p, _, _ in self.model.pieces])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum())), sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of every text of a batch."""
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        plain = np.array([self.by_space and bool(t) and b"  " not in t and t[:1] != b" " and t[-1:] != b" " for t in texts], bool)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        rest = np.flatnonzero(~plain).tolist()
        flat, sizes = self._encode([texts[k].decode("utf-8", "replace") for k in rest])
        for k, part in zip(rest, np.split(flat, np.cumsum(sizes)[:-1])):
            out[k] = part
        rows = np.flatnonzero(plain).tolist()
        data, offsets = joined_parts([texts[k] for k in rows])
        raw = data.tobytes()
        hashes, starts, ends, number, counts = distinct_words(data, offsets, ONLY_SPACE)
        new = lambda w: self._encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[w].tolist(), ends[w].tolist())])
        begin, size = self.known.look_up(hashes, new)
        ids, ends = gathered(self.known.flat, begin[number], size[number])
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        for k, a, b in zip(rows, edges, edges[1:]):
            out[k] = ids[a:b]
        return out

    def _decode(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        texts = [t.encode() for t in self.tool.decode_batch(ids, skip_special_tokens=False)]
        return np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The texts of lists of ids. Stretches that open with a space are decoded one by one, known ones from memory."""
        sizes = np.array([len(t) for t in texts], np.int64)
        ids = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        if not len(ids):
            return [b""] * len(texts)
        opens = self.opens[ids]
        opens[bounds[:-1][sizes > 0]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(ids))
        hashes = _hashes(ids.astype("<i4").view(np.uint8), starts * 4, ends * 4, False)
        found, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        new = lambda w: self._decode([ids[a:b].tolist() for a, b in zip(starts[first[w]].tolist(), ends[first[w]].tolist())])
        begin, size = self.read.look_up(found, new)
        raw, stops = gathered(self.read.flat, begin[number], size[number])
        places = np.concatenate([[0], stops])[np.searchsorted(starts, bounds)].tolist()
        raw = raw.tobytes()
        prefix = b" " if self.model.dummy_prefix else b"\0"
        return [raw[a + (raw[a : a + 1] == prefix and b > a) : b] for a, b in zip(places, places[1:])]


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """This worker's codec for a model file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, n_bytes)`` of every whole text: its ids and how many are bytes of characters without a piece.

    Null texts are encoded like empty ones: no ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                ids = tool.encode(*binary_parts(batch.column("text")))
                in_bytes = pa.array([int(tool.is_byte[x].sum()) for x in ids], pa.int64())
                yield pa.record_batch([batch.column("id"), _lists(ids), in_bytes], ["id", "ids", "n_bytes"])

    rows = texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "id bigint, ids array<int>, n_bytes bigint")


def with_ids(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` but the text, with ``ids``; an ``ids`` column of ``docs`` is replaced.

    A text that its ids do not decode to, as happens with the model's own marks in it, keeps its ids: they are what
    the model makes of it.
    """
    fields = [f for f in docs.schema.fields if f.name not in (text_col, "ids")]
    rows = docs.select(*[f"`{f.name}`" for f in fields], as_bytes(text_col).alias("_text"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                rest = [batch.column(k) for k in range(len(fields))]
                yield pa.record_batch([*rest, _lists(tool.encode(*binary_parts(batch.column(len(fields)))))], [*[f.name for f in fields], "ids"])

    return rows.mapInArrow(run, schema)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """``(id, text)`` from ``(id, ids)``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                ids = [np.array(x.as_py() or [], np.int32) if not x.is_valid else x.values.to_numpy() for x in batch.column("ids")]
                texts = [t.decode("utf-8", "replace") for t in tool.decode(ids)]
                yield pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return tokens.select("id", "ids").mapInArrow(run, "id bigint, text string")


def round_trips(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_pieces, n_bytes, ids_crc32, round_trip)`` of every text: encoded, decoded, compared in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                data, offsets = binary_parts(batch.column("text"))
                ids, raw = tool.encode(data, offsets), data.tobytes()
                back = tool.decode(ids)
                same = [raw[a:b] == t for a, b, t in zip(offsets[:-1].tolist(), offsets[1:].tolist(), back)]
                columns = [
                    batch.column("id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([int(tool.is_byte[x].sum()) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array(same, pa.bool_()),
                ]
                yield pa.record_batch(columns, ["id", "n_pieces", "n_bytes", "ids_crc32", "round_trip"])

    rows = texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "id bigint, n_pieces bigint, n_bytes bigint, ids_crc32 bigint, round_trip boolean")


def parity(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, same_ids, same_text)``: whether the model's own library gives the same ids, and from them the same text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        own, tool = sentencepiece.SentencePieceProcessor(model_file=path), codec(path)
        for batch in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            ids, theirs = tool.encode(*joined_parts([t.encode() for t in texts])), own.encode(texts)
            same = [x.tolist() == y for x, y in zip(ids, theirs)]
            text = [x.decode() == y for x, y in zip(tool.decode(ids), own.decode(theirs))]
            yield pa.record_batch([batch.column("id"), pa.array(same), pa.array(text)], ["id", "same_ids", "same_text"])

    rows = texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "id bigint, same_ids boolean, same_text boolean")
