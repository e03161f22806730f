import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from loomframe.llm import bpe, queries
from loomframe.llm.words import joined_parts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(PATH)
    tool.no_truncation()
    tool.no_padding()
    return tool


def own_ids(texts):
    return [x.tolist() for x in bpe.codec(PATH).encode(*joined_parts([t.encode() for t in texts]))]


ODD = [
    "",
    " ",
    "  two  spaces ",
    "it's they'll WE'RE don't 'tis",
    "a\n\nb \n c\t\td\r\n",
    "tail   ",
    "a b  c  d  e　f\u0085",
    "x   y",
    "日本語のテキスト、漢字。",
    "naïve café ünïcödé",
    "😀😀 👩‍👩‍👧 é",
    "12345 3.14 ½ ٣٤",
    "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|><|endoftext|>c <|endoftext",
    "a" * 5000 + " " + "ab" * 3000,
    "՘࢏Ᲊ new letters \U0003fc36x",
    "\x1c\x1d\x1e\x1f\x00\x7f",
    " ​﻿ x",
]


def test_odd_texts(library):
    assert own_ids(ODD) == [library.encode(t, add_special_tokens=False).ids for t in ODD]


def test_long_piece_of_many_ranks(library):
    text = "".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyz", k=20000))
    assert own_ids([text])[0] == library.encode(text, add_special_tokens=False).ids


ALPHABET = st.sampled_from([*" \n\t'abcdestlmrv19.,!-", " ", " ", "é", "日", "😀", "<|endoftext|>", "  ", " the", "ing"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), min_size=1, max_size=8))
def test_random_texts(library, texts):
    ids = own_ids(texts)
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [bpe.codec(PATH).decode(np.array(x, np.int32)) for x in ids] == texts


def test_broken_utf8_and_unknown_ids(library):
    ids = library.encode("é", add_special_tokens=False).ids
    tool = bpe.codec(PATH)
    broken = library.encode("日", add_special_tokens=False).ids[:1]
    assert tool.decode(np.array(broken)) == library.decode(broken, skip_special_tokens=False)
    assert tool.decode(np.array([-1, *ids, 10**6])) == "é"


def test_memory_forgets():
    tool = bpe.Codec(PATH)
    tool.known.most = 3
    texts = ["one two three", "four five six", "one two three"] * 3
    assert [x.tolist() for t in texts for x in tool.encode(*joined_parts([t.encode()]))] == own_ids(texts)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))


def test_frames(spark, docs, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, "same id"), (1, "same id"), (None, "no id"), (99, None)]
    frame = docs(rows).withColumns({"ids": F.lit("clash"), "id": F.lit(0)})
    back = bpe.decoded(bpe.encoded(frame, PATH), PATH).collect()
    assert len(back) == len(rows)
    expected = sorted((str(i), t or "", library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted((str(r.id), r.text, r.ids) for r in back) == expected
    assert bpe.decoded(bpe.encoded(docs([]), PATH), PATH).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [None, 262])], "id bigint, ids array<int>")
    assert [r.text for r in bpe.decoded(odd, PATH).sort("id").collect()] == ["", library.decode([262])]


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in queries.op11_bpe(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (found[r.doc_id].n_tokens, found[r.doc_id].ids_sha256, found[r.doc_id].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(text))
