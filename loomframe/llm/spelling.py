"""Spelling variants: the words of a corpus that differ by one code point, and the common form of each.

Candidates come from asymmetric q-chunks. Of two near words the shorter (or either of equal ones) contributes its two
halves as disjoint chunks, the other the positional grams of the same sizes within a shift of one: one edit leaves a
chunk whole, so the words meet in a join on (length, chunk). What meets is verified by its edit distance.

A chunk that many words have is cut further, as its words need not all be compared: where the one chunk is whole, the
rest of the words differ by one edit, so one of the two halves of the rest is whole as well. Joins are taken from keys
of at most MEETINGS candidates, or whose rest is one code point, which an alphabet bounds. No candidate is dropped.

Words are distinct values with counts from the start, so frequent words are one row each. Null texts have no words, a
null id reads as an empty one; equal rows count each. A corpus without words gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loomframe.session import drop_written, materialise

#: Letters of a run, as a Java pattern.
RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Candidates of a key that are compared without cutting it further.
MEETINGS = 4096
#: How many times as frequent a form is as its variant.
RATIO = 10
ROUNDS = 64


def misspelt(key: Column, run: Column, one_in: int = 31) -> Column:
    """The run without one code point where ``one_in`` divides the checksum of ``key:run``, which also tells the place."""
    drawn = F.crc32(F.concat(key, F.lit(":"), run))
    at = F.pmod(drawn, F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(drawn % one_in == 0, without).otherwise(run)


def word_counts(docs: DataFrame, least: int = 7, times: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: distinct misspelt runs of at least ``least`` code points that occur at least ``times`` times."""
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"{RUN}{{{least},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("run"))
    rows = rows.select("key", F.translate("run", UPPER, LOWER).alias("run"))
    words = rows.select(misspelt(F.col("key"), F.col("run")).alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times)


def halves(states: DataFrame) -> DataFrame:
    """Each state's two states: a half of the rest as part of the key, the other half as the rest.

    States are ``(word, key, rest, shift)``; ``shift`` is how many code points more the rest has than that of the
    words that contribute chunks: they have 0, those that contribute grams 0 or 1.
    """
    size, longer = F.length("rest"), F.col("shift")
    front = F.floor((size - longer) / 2).cast("int")
    back = size - longer - front
    first = F.substring(F.col("rest"), F.lit(1), front)
    last = F.substring(F.col("rest"), size - back + 1, back)
    state = lambda side, chunk, rest: F.struct(F.xxhash64("key", F.lit(side), chunk).alias("key"), rest.alias("rest"))
    both = F.array(
        state(1, first, F.substring(F.col("rest"), front + 1, size)),
        state(2, last, F.substring(F.col("rest"), F.lit(1), size - back)),
    )
    return states.withColumn("each", F.explode(both)).select("word", F.col("each.key").alias("key"), F.col("each.rest").alias("rest"), "shift")


def near_words(words: DataFrame) -> DataFrame:
    """``(a, b)``: pairs of words that differ by one code point, ``a`` the shorter or, of equal lengths, the smaller."""
    start = lambda shift: words.select(
        "word", F.xxhash64(F.length("word") - shift).alias("key"), F.col("word").alias("rest"), F.lit(shift).alias("shift")
    )
    chunks, grams = start(0), start(0).union(start(1))
    found, written = [], []
    for depth in range(ROUNDS):
        chunks, grams = materialise(halves(chunks), f"chunks-{depth}"), materialise(halves(grams), f"grams-{depth}")
        written += [chunks, grams]
        many = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("x"), F.max(F.length("rest")).alias("size"))
        many = many.join(grams.groupBy("key").agg(F.count(F.lit(1)).alias("y")), "key")
        deeper = (F.col("x") * F.col("y") > MEETINGS) & (F.col("size") > 1)
        keys = materialise(many.select("key", deeper.alias("deeper")), f"chunk-keys-{depth}")
        written.append(keys)
        small = keys.where("NOT deeper").select("key")
        left = chunks.join(small, "key", "left_semi").select("key", F.col("word").alias("a"))
        right = grams.join(small, "key", "left_semi").select("key", F.col("word").alias("b"), "shift")
        met = left.join(right, "key").where("(shift = 1 OR a < b) AND levenshtein(a, b, 1) = 1")
        found.append(materialise(met.select("a", "b"), f"near-words-{depth}"))
        large = keys.where("deeper").select("key")
        if large.isEmpty():
            break
        chunks, grams = chunks.join(large, "key", "left_semi"), grams.join(large, "key", "left_semi")
    else:
        raise RuntimeError(f"words of more than 2 to the {ROUNDS} code points")
    pairs = materialise(reduce(DataFrame.union, found).distinct(), "near-words")
    for frame in written + found:
        drop_written(frame)
    return pairs


def last_forms(forms: DataFrame) -> DataFrame:
    """``(word, last)`` from ``(word, form)``: where following the forms ends, twice as far each round."""
    table = materialise(forms.select("word", F.col("form").alias("last")), "forms")
    for _ in range(ROUNDS):
        further = table.select(F.col("word").alias("last"), F.col("last").alias("beyond"))
        moved = materialise(table.join(further, "last", "left").select("word", F.coalesce("beyond", "last").alias("last"), F.col("beyond").isNotNull().alias("on")), "forms")
        drop_written(table)
        table = moved.select("word", "last")
        if moved.where("on").isEmpty():
            return table
    raise RuntimeError("forms do not end")


def variants(words: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of distinct ``(word, n)``.

    A word's form is its near word of the largest n, of those the first in code-point order, if it is RATIO times as
    frequent; its root is where the forms end, the word itself if it has none.
    """
    words = materialise(words.select("word", "n"), "words")
    pairs = near_words(words)
    both = pairs.union(pairs.select("b", "a")).toDF("word", "other")
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best")
    near = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    rows = words.join(near, "word", "left")
    enough = -F.col("best.less") >= RATIO * F.col("n")
    rows = rows.select(
        "word",
        F.when(enough, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    rows = materialise(rows, "variants")
    ends = last_forms(rows.where("form IS NOT NULL"))
    found = rows.join(ends, "word", "left")
    return found.select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")
