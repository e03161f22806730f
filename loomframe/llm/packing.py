"""Token ids in a fixed-width bit-packed file format, with random access.

A file set is a table of blocks. A block holds the ids of consecutive documents of one key range, each id in the
least number of bits that the vocabulary needs, least significant bit first, in one byte string; beside it stand the
documents' keys and, as block offsets, where each begins. Any id is found by arithmetic, any stretch is unpacked by
a few numpy operations. Blocks are rows of Parquet files, so they can lie in any store that Spark reads and writes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loomframe.llm.common import range_number, width
from loomframe.llm.words import Memory, binary_parts, distinct_words, gathered, texts_of
from loomframe.session import scratch_path

#: Ids in a block, about: a block is closed by the document that reaches this number.
BLOCK_IDS = 1 << 18
BLOCKS = "range int, block int, keys binary, null_keys binary, starts binary, first bigint, ids bigint, bits int, packed binary"
#: Words whose characters the tokenizer treats one by one: ASCII but digits and the apostrophe, and accented letters.
PLAIN = re.compile(r"[!-&(-/:-~À-ÖØ-öø-ÿ]+")
#: What the pattern tells apart in them.
RUNS = re.compile(r"[a-zß-öø-ÿ]+|[^a-zß-öø-ÿ]+")


def bits_for(vocabulary: int) -> int:
    """The least number of bits that holds every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids of the given width, one after the other."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """The ids from place ``start`` to before ``stop``; no others are touched."""
    if bits in (8, 16, 32):
        return np.frombuffer(packed, f"<u{bits // 8}", stop - start, start * bits // 8).astype(np.int64)
    low = start * bits // 8
    raw = np.frombuffer(packed, np.uint8)[low : (stop * bits + 7) // 8]
    flags = np.unpackbits(raw, bitorder="little")[start * bits - 8 * low :][: (stop - start) * bits]
    return flags.reshape(-1, bits).astype(np.int64) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def word_tokenizer(path: str):
    """``encode(words) -> (ids of all, number of ids of each)`` for a vocabulary file whose tokens never reach over white space.

    Plain words take a copy of the tokenizer without its normaliser and with simpler splitting; in them lower case is
    all that the normaliser does, and runs of letters and of other characters are all that the pattern tells apart.
    Any other word goes through the tokenizer as it is.
    """
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    whole = Tokenizer.from_file(path)
    plain = Tokenizer.from_file(path)
    plain.normalizer = normalizers.Sequence([])
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Punctuation("contiguous"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    closes = np.zeros(whole.get_vocab_size() + 1, bool)
    closes[[i for token, i in whole.get_vocab().items() if token.endswith("</w>")]] = True

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [w.decode("utf-8", "replace") for w in words]
        easy = np.array([bool(PLAIN.fullmatch(t)) and not ("<|" in t and any(s in t for s in special)) for t in texts], bool)
        sizes = np.zeros(len(texts), np.int64)
        easy_rows, hard_rows = np.flatnonzero(easy), np.flatnonzero(~easy)
        low = [texts[k].lower() for k in easy_rows.tolist()]
        # 256 words to a text: calls would cost more than the work otherwise. The last token of a run closes it.
        lines = [" ".join(low[i : i + 256]) for i in range(0, len(low), 256)]
        ids = [e.ids for e in plain.encode_batch_fast(lines, add_special_tokens=False)]
        easy_ids = np.fromiter((i for e in ids for i in e), np.uint32, sum(map(len, ids)))
        closed = np.flatnonzero(closes[easy_ids])
        last = closed[np.cumsum([len(RUNS.findall(t)) for t in low]) - 1] if low else np.zeros(0, np.int64)
        sizes[easy_rows] = np.diff(last, prepend=-1)
        odd = [e.ids for e in whole.encode_batch_fast([texts[k] for k in hard_rows.tolist()], add_special_tokens=False)]
        sizes[hard_rows] = [len(e) for e in odd]
        flat = np.zeros(int(sizes.sum()), np.uint32)
        where = np.repeat(easy, sizes)
        flat[where] = easy_ids
        flat[~where] = np.fromiter((i for e in odd for i in e), np.uint32, sum(map(len, odd)))
        return flat, sizes

    return encode


_MEMORY: dict[str, tuple] = {}


def word_memory(path: str) -> tuple:
    """``(encode, memory of words' ids)`` of this worker for a vocabulary file."""
    if path not in _MEMORY:
        _MEMORY[path] = word_tokenizer(path), Memory(np.uint32)
    return _MEMORY[path]


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", kind: str = "<u4") -> DataFrame:
    """``(id, ids)``: the ids of every whole text and ``end_id`` behind them, as integers of that kind.

    A null text is encoded like an empty one. A worker encodes each word that it has not met before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memory = word_memory(path)
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                data, offsets = binary_parts(batch.column("text"))
                hashes, starts, stops, number, counts = distinct_words(data, offsets)
                raw = data.tobytes()
                compute = lambda w: encode([raw[a:b] for a, b in zip(starts[w].tolist(), stops[w].tolist())])
                begin, sizes = memory.look_up(hashes, compute)
                all_ids, ends = gathered(memory.flat, begin[number], sizes[number])
                edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
                all_ids, end = all_ids.astype(kind), np.array([end_id], kind).tobytes()
                out = [all_ids[a:b].tobytes() + end for a, b in zip(edges[:-1], edges[1:])]
                yield pa.record_batch([batch.column("id").cast(pa.int64()), pa.array(out, pa.binary())], ["id", "ids"])

    rows = texts_of(docs, id_col, text_col)
    return rows.withColumn("id", F.col("id").cast("long")).mapInArrow(run, "id bigint, ids binary")


def write_blocks(tokens: DataFrame, path: str, bits: int, block_ids: int = BLOCK_IDS, kind: str = "<u4") -> None:
    """Write ``(id, ids)`` as blocks in ascending order of id (null first, equal ids by content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nulls, sizes, held = [], [], [], []
        now, block, first, total = None, 0, 0, 0

        def close():
            ids = np.concatenate(held)
            starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
            row = [now, block, np.array(keys, "<i8").tobytes(), np.array(nulls, np.uint8).tobytes(), starts.tobytes(), first, len(ids), bits, pack(ids, bits)]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            names = [f.split()[0] for f in BLOCKS.split(", ")]
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for number, key, ids in zip(batch.column("range").to_pylist(), batch.column("id").to_pylist(), batch.column("ids")):
                if held and (number != now or total >= block_ids):
                    yield close()
                    first, block = (first + total, block + 1) if number == now else (0, 0)
                    keys, nulls, sizes, held, total = [], [], [], [], 0
                elif number != now:
                    first = block = 0
                now = number
                values = np.frombuffer(ids.as_buffer(), kind)
                keys.append(key or 0)
                nulls.append(key is None)
                sizes.append(len(values))
                held.append(values)
                total += len(values)
        if held:
            yield close()

    parts = width(tokens)
    ranged = tokens.withColumn("range", range_number(tokens, "id", parts)) if "range" not in tokens.columns else tokens
    ranged = ranged.repartition(parts, "range").sortWithinPartitions("range", F.col("id").asc_nulls_first(), "ids")
    ranged.select("range", "id", "ids").mapInArrow(run, BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of every document, from the files.

    ``start`` counts the ids of all documents before it. The totals of the ranges, which give each range's first
    place, are one row per range.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sums = blocks.groupBy("range").agg(F.sum("ids").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                ids = unpack(row["packed"], row["bits"], 0, row["ids"]).astype("<u4")
                starts = np.frombuffer(row["starts"], "<i8")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts, starts[1:])]
                nulls = np.frombuffer(row["null_keys"], np.uint8).astype(bool)
                keys = pa.array(np.frombuffer(row["keys"], "<i8"), pa.int64(), mask=nulls)
                place = row["offset"] + row["first"] + starts
                yield pa.record_batch(
                    [keys, pa.array(place[:-1], pa.int64()), pa.array(np.diff(starts), pa.int64()), pa.array(crc, pa.int64())],
                    ["id", "start", "n_tokens", "ids_crc32"],
                )

    whole = blocks.join(F.broadcast(offsets), "range").select("offset", "first", "ids", "bits", "keys", "null_keys", "starts", "packed")
    return whole.mapInArrow(run, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def ids_at(spark: SparkSession, path: str, start: int, stop: int) -> list[int]:
    """A stretch of the whole id sequence, read from the blocks that hold it alone (random access)."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sums = blocks.groupBy("range").agg(F.sum("ids").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    begin = F.col("offset") + F.col("first")
    hit = blocks.join(F.broadcast(offsets), "range").where((begin < stop) & (begin + F.col("ids") > start)).orderBy(begin)
    out: list[int] = []
    for row in hit.select(begin.alias("begin"), "ids", "bits", "packed").toLocalIterator():
        a, b = max(start - row["begin"], 0), min(stop - row["begin"], row["ids"])
        out += unpack(bytes(row["packed"]), row["bits"], a, b).tolist()
    return out


def token_files(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode ``docs``, write the blocks to the shared folder, give their path."""
    from tokenizers import Tokenizer

    path = scratch_path(docs.sparkSession, "tokens")
    # The ranges come from the keys alone, so that the texts are encoded once.
    parts = width(docs)
    cut = range_number(docs.select(F.col(id_col).cast("long").alias("id")), "id", parts)
    bits = bits_for(max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1))
    kind = "<u2" if bits <= 16 else "<u4"  # as few bytes as can be sorted into ranges
    tokens = encoded(docs, tokenizer, end_id, id_col, text_col, kind).withColumn("range", cut)
    write_blocks(tokens, path, bits, kind=kind)
    return path
