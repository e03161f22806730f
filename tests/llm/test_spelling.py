import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomframe.llm import queries, spelling


def near(a, b):
    """Whether one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def counted(rows):
    words = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def brute(words):
    """The query's rows from ``{word: n}``, all pairs compared."""
    all_near = {w: [x for x in words if near(w, x)] for w in words}
    forms = {}
    for w, others in all_near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                forms[w] = best
    out = []
    for w in words:
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, words[w], len(all_near[w]), words[forms[w]] if w in forms else None))
    return sorted(out, key=str)


def rows_of(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


def word_table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def mutated(draw, word, letters):
    at, kind = draw.randrange(len(word)), draw.randrange(3)
    return word[:at] + (draw.choice(letters) if kind else "") + word[at + (kind < 2) :]


@pytest.mark.parametrize("meetings", [1, 4096])
def test_random_words(spark, monkeypatch, meetings):
    monkeypatch.setattr(spelling, "MEETINGS", meetings)
    draw = random.Random(8)
    words = {}
    for letters, stems in (("abcàÿ", 40), ("ab", 30), ("abcdefghij", 40)):
        for _ in range(stems):
            word = "".join(draw.choices(letters, k=draw.randrange(7, 12)))
            for _ in range(6):
                words[word] = draw.choice([2, 3, 25, 30, 400, 4000])
                word = mutated(draw, word, letters)
    words = {w: n for w, n in words.items() if len(w) >= 7}
    words["a" * 300], words["a" * 301], words["a" * 150 + "b" + "a" * 150] = 2, 3, 500
    assert rows_of(spelling.variants(word_table(spark, words))) == brute(words)


def test_common_halves(spark, monkeypatch):
    """One prefix on all words: its key is cut further, and fewer pairs meet than there are."""
    draw = random.Random(2)
    words = {"prefix" + "".join(draw.choices("abcdefgh", k=6)): 2 for _ in range(1500)}
    words |= {mutated(draw, w, "abcdefgh"): 20 for w in list(words)[:300]}
    words = {w: n for w, n in words.items() if len(w) >= 7}
    assert rows_of(spelling.variants(word_table(spark, words))) == brute(words)


def test_chains_and_ties(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "zaaaaaa": 20, "lonesome": 5}
    found = {r[0]: r for r in rows_of(spelling.variants(word_table(spark, words)))}
    assert found["aaaaaaa"] == ("aaaaaaa", "aaaaaab", "aaabbbb", 2, 2, 20)
    assert found["lonesome"] == ("lonesome", None, "lonesome", 5, 0, None)
    assert rows_of(spelling.variants(word_table(spark, words))) == brute(words)


def test_texts(spark, docs):
    draw = random.Random(4)
    stems = ["Morning", "évening", "AFTERNOON", "streßful", "señoritas", "×multiply÷", "co-operate", "x" * 40, "ÀÉÎÕÜàéîõü"]
    rows = [(i, " ".join(draw.choices(stems, k=60)) + "\n\x00" + mutated(draw, draw.choice(stems), "abcé")) for i in range(120)]
    rows += [(None, "nothing nothing"), (5, None), (6, ""), (7, "short w"), (8, "repeated repeated"), (8, "repeated repeated"), (9, "big " + "longest " * 20000)]
    frame = docs(rows).withColumns({"word": F.lit("clash"), "key": F.lit(1), "n": F.lit(2)})
    assert rows_of(spelling.variants(spelling.word_counts(frame))) == brute(counted(rows))
    assert rows_of(spelling.variants(spelling.word_counts(docs([])))) == []


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op13_spelling_variants(spark, sf)) == brute(counted(rows))
