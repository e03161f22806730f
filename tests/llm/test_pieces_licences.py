"""SentencePiece parity, and licence rules against a plain walk over the sentences."""

import random
import re

import pytest
from pyspark.sql import functions as F

from loomframe.llm import licences, pieces

TEXTS = [None, "", " ", "a", "two  spaces", " lead", "tail ", "line\nbreak\n\n  x", "漢字🙂\x00� é", "The quick brown fox. " * 300, "<s> </s> <0x41> ▁", "The quick"]


def test_parity(spark, docs):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("piece_bpe_32k.model")
    frame = docs(list(enumerate(TEXTS))).withColumn("ids", F.lit("clash"))
    assert all(r["same_ids"] and r["same_text"] for r in pieces.parity(frame, path).collect())
    tokens = pieces.encoded(frame, path)
    back = {r["id"]: r["text"] for r in pieces.decoded(tokens, path).collect()}
    odd = {10}  # marks of the model in a text come back as spaces
    assert all(back[k] == (t or "") for k, t in enumerate(TEXTS) if k not in odd)
    trips = {r["id"]: r for r in pieces.round_trips(frame, path).collect()}
    assert all(trips[k]["round_trip"] for k in range(len(TEXTS)) if k not in odd)
    assert trips[8]["n_bytes"] > 0 and trips[0]["n_pieces"] == 0
    assert pieces.encoded(docs([]), path).count() == 0


def test_unigram_model(tmp_path):
    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3]) + bytes([value])
        if isinstance(value, float):
            import struct

            return bytes([number << 3 | 5]) + struct.pack("<f", value)
        return bytes([number << 3 | 2, len(value)]) + value

    made = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁", -3.0, 1), ("a", -3.0, 1), ("ab", -1.5, 1)]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in made)
    data += field(2, field(3, 1)) + field(3, field(3, 1) + field(4, 1))
    (tmp_path / "m.model").write_bytes(data)
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "m.model"))
    tool = pieces.Codec(str(tmp_path / "m.model"))
    for text in ("ab", "a  b aab ", "abab b"):
        (ids,) = tool.encode(*pieces.joined_parts([text.encode()]))
        assert ids.tolist() == own.encode(text)
        assert tool.decode([ids]) == [own.decode(own.encode(text)).encode()]


def plain_scan(text):
    parts = re.split(licences.ENDS, text or "")
    said = [" ".join(re.findall("[a-z0-9]+", p.lower())) for p in parts]
    names = {t: i for i, t in licences.SENTENCES.items()}
    known = [(k, names[s]) for k, s in enumerate(s for s in said if s) if s in names]
    out = set()
    for name in {r.licence for r in licences.RULES}:
        mine = [r for r in licences.RULES if r.licence == name]
        best = None
        for r in mine:
            runs = [[k] for k, s in known if s == r.sentences[0]]
            for step in r.sentences[1:]:
                runs = [[*run, k] for run in runs for k, s in known if s == step and 1 <= k - run[-1] <= r.gap + 1]
            if runs and (best is None or len(r.sentences) > best[0]):
                last, first = min((run[-1], -run[0]) for run in runs)
                best = (len(r.sentences), -first, last)
        seen = [(k, s) for k, s in known if any(s in r.sentences for r in mine)]
        if best:
            out.add((name, True, *best))
        elif seen:
            out.add((name, False, len({s for _, s in seen}), seen[0][0], seen[-1][0]))
    return out


def test_licences(spark, docs):
    rng = random.Random(2)
    sentences = list(licences.SENTENCES.values())
    bsd = [licences.SENTENCES[f"bsd-{k}"] for k in ("redistribution", "retain", "reproduce", "endorse")]
    texts = [None, "", "no such thing", "Licensed under CC BY-NC 4.0.", "x\nReleased under the MIT License.\ny", "Released under the MIT License!! " * 2000]
    for k in range(60):
        words = rng.sample(sentences, 4) + bsd[: rng.randint(0, 4)] + ["Some other words"] * rng.randint(0, 6)
        if k % 3 == 0:
            rng.shuffle(words)
        elif k % 3 == 1:
            words = [x for w in words for x in [w] + ["filler here"] * rng.randint(0, 3)]
        texts.append("\n".join(w.capitalize() + rng.choice([".", "!", ""]) for w in words))
    found: dict = {}
    for r in licences.recognised(docs(list(enumerate(texts)))).collect():
        found.setdefault(r["id"], set()).add(tuple(r)[1:])
    for k, text in enumerate(texts):
        assert found.get(k, set()) == plain_scan(text), k
    assert licences.recognised(docs([])).count() == 0


def test_every_sentence_has_a_hint_and_is_normal():
    for s in licences.SENTENCES.values():
        assert re.search(licences.HINTS, s) and " ".join(re.findall("[a-z0-9]+", s)) == s
    assert {s for r in licences.RULES for s in r.sentences} == set(licences.SENTENCES)


APACHE = """Copyright 2020 A B

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

     http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_official_texts_are_found_however_they_are_wrapped(spark, docs):
    official = [("Apache-2.0", APACHE, 4), ("GPL-3.0", GPL, 3), ("MPL-2.0", MPL, 1), ("MIT", MIT, 2), ("BSD-3-Clause", BSD, 4)]
    texts = [t for _, t, _ in official]
    texts += [re.sub("^", "# ", t, flags=re.M) for t in texts] + ["\r\n".join(t.split()) for t in texts[:3]] + [GPL.replace("software:", "software;")]
    found = {(r["id"], r["licence"]): r for r in licences.recognised(docs(list(enumerate(texts)))).collect()}
    for k in range(len(texts)):
        name, _, n = official[k % 5 if k < 13 else 1]
        assert found[k, name]["complete"] and found[k, name]["n_sentences"] == n, (k, name)
    assert found[1, "GPL-3.0"]["first_sentence"] == 0 and found[1, "GPL-3.0"]["last_sentence"] == 10
    # Parts of a sentence, or words between its lines, are no sentence.
    broken = [MPL.replace("Public\n", "Public\nor\n"), "Released under\nthe MIT", "under\nthe MIT License"]
    assert licences.recognised(docs(list(enumerate(broken)))).count() == 0


def test_sentences_of_ones_own_need_no_hint(spark, docs):
    rules = (licences.Rule("own", ("a", "b")),)
    frame = docs([(1, "Do as\nyou like. Tell nobody"), (2, "Do as you. Tell nobody")])
    found = licences.recognised(frame, rules, {"a": "do as you like", "b": "tell nobody"}).collect()
    assert {(r["id"], r["complete"], r["first_sentence"], r["last_sentence"]) for r in found} == {(1, True, 0, 2), (2, False, 1, 1)}
