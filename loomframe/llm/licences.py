"""Recognising licences by their sentences, with DataFrame functions only.

A text is cut at line breaks and stops, and each piece is normalised. A known licence sentence is there where pieces
that follow each other, joined, are its words: wrapped lines, blank lines and stops inside a sentence ("v. 2.0",
"WARRANTY; without") do not hide it. What is left of a text is a sequence of sentence identifiers with their pieces. A licence is recognised where the identifiers of one of its rules follow
each other in the rule's order, with at most the rule's number of other pieces between two of them. Of rules that
match, the one with the most sentences names the licence; a licence none of whose rules matches, although some of its
sentences are there, is reported as not complete.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Sentences of well-known licences and notices, by identifier, normalised as `normalised` does.
SENTENCES = {
    "apache2-notice": "licensed under the apache license version 2 0",
    "apache2-you-may-not": "you may not use this file except in compliance with the license",
    "apache2-obtain": "you may obtain a copy of the license at",
    "apache2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-retain": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-reproduce": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-4-notice": "licensed under cc by 4 0",
    "cc-by-nc-4-notice": "licensed under cc by nc 4 0",
    "cc-by-nc-nd-4-notice": "licensed under cc by nc nd 4 0",
    "cc-by-nc-sa-4-notice": "licensed under cc by nc sa 4 0",
    "cc-by-nd-4-notice": "licensed under cc by nd 4 0",
    "cc-by-sa-4-notice": "licensed under cc by sa 4 0",
    "cc0-notice": "this work is dedicated to the public domain under cc0 1 0",
    "gpl2-notice": "this work is licensed under the gnu general public license version 2",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free-software": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-no-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "lgpl3-notice": "this work is licensed under the gnu lesser general public license version 3",
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-granted": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-included": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mpl2-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

# Other wordings of the sentences above in the licences' official texts, normalised likewise.
WORDINGS = {
    "licensed under the apache license version 2 0 the license": "apache2-notice",
}


@dataclass(frozen=True)
class Rule:
    licence: str
    sentences: tuple[str, ...]
    #: Other pieces of text that may stand between two of the rule's.
    gap: int = 3


# The sentences that make a licence, in their order.
RULES = (
    Rule("Apache-2.0", ("apache2-notice", "apache2-you-may-not", "apache2-obtain", "apache2-as-is")),
    Rule("Apache-2.0", ("apache2-notice",)),
    Rule("BSD-2-Clause", ("bsd-redistribution", "bsd-retain", "bsd-reproduce")),
    Rule("BSD-3-Clause", ("bsd-redistribution", "bsd-retain", "bsd-reproduce", "bsd-endorse")),
    Rule("CC-BY-4.0", ("cc-by-4-notice",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4-notice",)),
    Rule("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4-notice",)),
    Rule("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-notice",)),
    Rule("CC-BY-ND-4.0", ("cc-by-nd-4-notice",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa-4-notice",)),
    Rule("CC0-1.0", ("cc0-notice",)),
    Rule("GPL-2.0", ("gpl2-notice",)),
    Rule("GPL-3.0", ("gpl3-notice",)),
    Rule("GPL-3.0", ("gpl-free-software", "gpl-no-warranty", "gpl-see")),
    Rule("LGPL-3.0", ("lgpl3-notice",)),
    Rule("MIT", ("mit-granted", "mit-included")),
    Rule("MIT", ("mit-notice",)),
    Rule("MIT", ("mit-notice-2",)),
    Rule("MPL-2.0", ("mpl2-notice",)),
)
#: Where texts are cut: line breaks, and stops before white space.
ENDS = r"[\n\r]+|[.!?;:]+[ \t\n\r\f]"
#: A text none of whose words is among these has none of SENTENCES.
HINTS = r"(?i)licen[sc]e|redistribut|warrant|copyright|cc0|endorse|compliance"


def normalised(sentence: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def sentences_of(text: Column) -> Column:
    """The normalised pieces of a text that hold any letter or digit."""
    return F.filter(F.transform(F.split(text, ENDS), normalised), lambda s: s != "")


def _known(wordings: dict[str, str]) -> Column:
    pairs = [x for s, i in sorted(wordings.items()) for x in (F.lit(s), F.lit(i))]
    return F.create_map(*pairs)


def _spans(said: Column, wordings: dict[str, str]) -> Column:
    """``(at, to, sentence)`` of every run of pieces that is a known sentence: its first and last piece, in order.

    Runs grow from pieces that a known sentence begins with, as long as it goes on with their words. A piece holds a
    word at least, so no run has more pieces than the longest sentence has words.
    """
    table = _known(wordings)
    every = F.array(*[F.lit(s + " ") for s in sorted(wordings)])
    firsts = sorted({s.split()[0] for s in wordings})
    longest = max(len(s.split()) for s in wordings)
    begins = lambda run: F.exists(every, lambda s: F.startswith(s, F.concat(run, F.lit(" "))))
    starts = F.filter(
        F.transform(said, lambda s, i: F.struct(i.alias("at"), s.alias("s"))),
        lambda x: F.substring_index(x["s"], " ", 1).isin(firsts) & begins(x["s"]),
    )
    none = F.array().cast("array<struct<at:int,to:int,sentence:string>>")

    def grown(x: Column) -> Column:
        state = F.struct(F.lit("").alias("run"), x["at"].alias("to"), none.alias("spans"))

        def move(s: Column, piece: Column) -> Column:
            run = F.when(s["run"] == "", piece).otherwise(F.concat_ws(" ", s["run"], piece))
            run = F.when(s["run"].isNotNull() & begins(run), run)
            here = F.struct(x["at"].alias("at"), s["to"].alias("to"), F.element_at(table, run).alias("sentence"))
            found = F.when(here["sentence"].isNotNull(), F.concat(s["spans"], F.array(here))).otherwise(s["spans"])
            return F.struct(run.alias("run"), (s["to"] + 1).alias("to"), found.alias("spans"))

        return F.aggregate(F.slice(said, x["at"] + 1, longest), state, move, lambda s: s["spans"])

    return F.flatten(F.transform(starts, grown))


def identified(docs: DataFrame, sentences: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, known)`` of the texts with known sentences: their first and last pieces and identifiers, in order.

    The table of known sentences is a constant of the query. Where it is :data:`SENTENCES`, each of which has a hint in
    it, texts without a hint are dropped before they are cut. Null and empty texts have no sentences.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if sentences is None:
        rows = rows.where(F.col("text").rlike(HINTS))
    wordings = {s: i for i, s in (sentences or SENTENCES).items()} | (WORDINGS if sentences is None else {})
    # The pieces are bound as the element of an array, so they are cut once and not for every start.
    spans = F.element_at(F.transform(F.array(sentences_of(F.col("text"))), lambda said: _spans(said, wordings)), 1)
    return rows.select("id", spans.alias("known")).where(F.size("known") > 0)


def _match(known: Column, rule: Rule) -> Column:
    """``(begin, end)`` of the first place where the rule's sentences follow in order, null if there is none.

    One pass over the known sentences: for each sentence of the rule the latest begin of a run that has come so far,
    and where it has come to; a later begin is never worse, as all runs end at the same sentence.
    """
    steps = range(len(rule.sentences))
    state = F.struct(*[F.lit(None).cast("struct<begin:int,end:int>").alias(f"s{k}") for k in steps], F.lit(None).cast("struct<begin:int,end:int>").alias("found"))

    def move(s: Column, x: Column) -> Column:
        new = {}
        for k, name in enumerate(rule.sentences):
            if k == 0:
                to = F.struct(x["at"].alias("begin"), x["to"].alias("end"))
            else:
                ready = s[f"s{k - 1}"]
                to = F.when((x["at"] - ready["end"]).between(1, rule.gap + 1), F.struct(ready["begin"].alias("begin"), x["to"].alias("end")))
            new[k] = F.when(x["sentence"] == name, F.coalesce(to, s[f"s{k}"])).otherwise(s[f"s{k}"])
        done = F.coalesce(s["found"], new[len(rule.sentences) - 1])
        return F.struct(*[new[k].alias(f"s{k}") for k in steps], done.alias("found"))

    return F.aggregate(known, state, move, lambda s: s["found"])


def _among(names: list[str]):
    return lambda x: x["sentence"].isin(names)


def recognised(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sentences: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, licence, complete, n_sentences, first_sentence, last_sentence)``: a row for each licence seen in a text.

    ``n_sentences`` is the number of sentences of the longest rule that matches, or, where none does, of different
    sentences of the licence's rules that are there; the places count the text's pieces from 0. Repeated rows
    give repeated results, texts without known sentences none.
    """
    found = identified(docs, sentences, id_col, text_col)
    names = sorted({r.licence for r in rules})
    rows = []
    for name in names:
        mine = sorted((r for r in rules if r.licence == name), key=lambda r: (-len(r.sentences), r.sentences))
        wanted = sorted({s for r in mine for s in r.sentences})
        tried = [(len(r.sentences), _match(F.col("known"), r)) for r in mine]
        whole = F.coalesce(*[F.when(m.isNotNull(), F.struct(F.lit(n).alias("n"), m["begin"].alias("begin"), m["end"].alias("end"))) for n, m in tried])
        seen = F.filter(F.col("known"), _among(wanted))
        part = F.when(
            F.size(seen) > 0,
            F.struct(
                F.lit(name).alias("licence"),
                F.lit(False).alias("complete"),
                F.size(F.array_distinct(F.transform(seen, lambda x: x["sentence"]))).alias("n"),
                F.element_at(seen, 1)["at"].alias("begin"),
                F.element_at(seen, -1)["to"].alias("end"),
            ),
        )
        full = F.when(whole.isNotNull(), F.struct(F.lit(name).alias("licence"), F.lit(True).alias("complete"), whole["n"].alias("n"), whole["begin"].alias("begin"), whole["end"].alias("end")))
        rows.append(F.coalesce(full, part))
    # Only texts with known sentences come this far; a text names few licences.
    listed = found.select("id", F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("r"))
    return listed.select(
        "id", "r.licence", "r.complete", F.col("r.n").alias("n_sentences"), F.col("r.begin").alias("first_sentence"), F.col("r.end").alias("last_sentence")
    )
