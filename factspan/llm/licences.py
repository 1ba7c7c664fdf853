"""License scans by a positional index of rare tokens.

A licence is known by clauses; a clause is a sequence of words, and the words in brackets are its
mandatory key phrases. A clause stands at a place of a file if at least ``agree`` of its words,
and all words of its key phrases, stand there at their positions relative to the place. A bare
phrase is a clause that is mandatory as a whole.

1. How many documents hold each word of the licences is counted over all documents. A clause of n
   words may lose floor(n * (1 - agree)) of them, so of any place at least one of one more words
   is intact: that many of its words, those of the highest inverse document frequency (the fewest
   documents; of equals the earlier), with their positions in the clause, are the index.
2. Every word of a file that stands in the index is looked up. A hit fixes the place (position in
   the file less position in the clause), and the clause's postings are intersected with the file
   at their relative positions.
3. The key phrases are verified, then the share of words that agree. Of several indexed words that
   agree at one place the rarest reports it, so each place counts once. No place is lost.

How it runs, all in DataFrame functions: words are exploded and meet the index, a broadcast table
of at most as many rows as the templates have words, inside of one stage; a hit takes along only
the few words of its place. One shuffle of a row for each document and each place adds them up.

Nulls: a null text is empty. A document without words has none of anything and score 0; a null key
passes; repeated rows are scanned each. Texts are scanned whole. An empty table gives an empty
result. Only the columns named are read, so columns of other names don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Clause:
    """``text``: words; key phrases in brackets. ``base``: a phrase whose places are counted."""

    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.replace("[", " ").replace("]", " ").split()

    @property
    def must(self) -> list[bool]:
        out, inside = [], self.base
        for w in self.text.replace("[", " [ ").replace("]", " ] ").split():
            if w in "[]":
                inside = w == "["
            else:
                out.append(inside)
        return out


#: The phrases that are counted, and clauses of licences in common use.
TEMPLATES = (
    Clause("cc-by", "cc by", base=True),
    Clause("gpl", "general public license", base=True),
    Clause("reserved", "all rights reserved", base=True),
    Clause("apache-2.0", "licensed under the [apache license version 2 0]"),
    Clause("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at [apache org licenses license 2 0]"),
    Clause("bsd", "[redistribution and use in source and binary forms] with or without modification are permitted provided that the following conditions are met"),
    Clause("bsd", "licensed under the [bsd] license"),
    Clause("cc-by-4.0", "licensed under a [creative commons attribution 4 0] international license"),
    Clause("cc-by-nc", "licensed under [cc by nc] 4 0"),
    Clause("cc-by-nc", "licensed under a [creative commons attribution noncommercial] 4 0 international license"),
    Clause("cc-by-sa", "licensed under [cc by sa] 4 0"),
    Clause("cc-by-sa", "licensed under a [creative commons attribution sharealike] 4 0 international license"),
    Clause("cc0", "[cc0 1 0] universal public domain dedication"),
    Clause("epl-2.0", "the terms of the [eclipse public license] v 2 0"),
    Clause("gpl-2.0", "licensed under the [gnu general public license version 2]"),
    Clause("gpl-3.0", "licensed under the [gnu general public license version 3]"),
    Clause("gpl-notice", "[free software you can redistribute it] and or modify it under the terms of the gnu general public license"),
    Clause("isc", "[permission to use copy modify] and or distribute this software for any purpose with or without fee is hereby granted"),
    Clause("lgpl", "the terms of the [gnu lesser general public license]"),
    Clause("mit", "released under the [mit license]"),
    Clause("mit", "licensed under the [mit license]"),
    Clause("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this software and associated documentation files"),
    Clause("mpl-2.0", "this source code form is subject to the terms of the [mozilla public license] v 2 0"),
    Clause("proprietary", "no part of this work [may be reproduced] or distributed in any form without the [prior written permission] of the publisher"),
    Clause("unlicense", "this is free and unencumbered software [released into the public domain]"),
)


def words(text: Column) -> Column:
    """The words of a text: runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def clauses(spark: SparkSession, templates: tuple[Clause, ...], agree: float) -> DataFrame:
    """One row per clause: clause (number), label, base, cwords, must, least (how many words have to agree)."""
    rows = []
    for k, c in enumerate(templates):
        if not c.words or not any(c.must):
            raise ValueError(f"a clause needs words and a key phrase: {c.text!r}")
        lost = int(len(c.words) * (1 - agree) + 1e-9)
        rows.append(F.struct(F.lit(k).alias("clause"), F.lit(c.label).alias("label"), F.lit(c.base).alias("base"), F.array(*map(F.lit, c.words)).alias("cwords"), F.array(*map(F.lit, c.must)).alias("must"), F.lit(len(c.words) - lost).alias("least")))
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def index(docs: DataFrame, text: str, templates: tuple[Clause, ...], agree: float) -> DataFrame:
    """The postings of each clause's rarest words: word, at (position in the clause), before (positions of its rarer ones), and the clause."""
    vocabulary = sorted({w for c in templates for w in c.words})
    held = docs.select(F.explode(F.array_intersect(words(F.col(text)), F.array(*map(F.lit, vocabulary)))).alias("word"))
    frequency = held.groupBy("word").agg(F.count("*").alias("n"))
    known = clauses(docs.sparkSession, templates, agree)
    spots = known.select("clause", F.posexplode("cwords").alias("at", "word")).join(frequency, "word", "left")
    ranked = spots.groupBy("clause").agg(F.transform(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at"))), lambda x: x["at"]).alias("order"))
    rare = known.join(ranked, "clause").select("*", F.posexplode(F.slice("order", F.lit(1), F.size("cwords") - F.col("least") + 1)).alias("rank", "at"))
    return rare.select("label", "base", "cwords", "must", "least", "at", F.slice("order", F.lit(1), F.col("rank")).alias("before"), F.get("cwords", F.col("at")).alias("word"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[Clause, ...] = TEMPLATES, agree: float = 0.8) -> DataFrame:
    """One row per document: key, n_words, places (label, base, start, share of the clause's words; in order)."""
    found = _places(docs, key, text, templates, agree)
    place = F.struct("start", "label", "base", "share")
    return found.groupBy("_row").agg(F.first("_key").alias(key), F.first("n_words").alias("n_words"), F.sort_array(F.collect_list(F.when(F.col("ok"), place))).alias("places")).drop("_row")


def _places(docs: DataFrame, key: str, text: str, templates: tuple[Clause, ...], agree: float) -> DataFrame:
    """A row for each place of a clause (ok) and each hit that is none, and at least one for each document.

    There is no filter on ``ok``: Spark would move it before the join's other filter, out of the compiled stage.
    """
    postings = index(docs, text, templates, agree)
    d = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), words(F.col(text)).alias("_w"))
    spots = d.select("_row", "_key", "_w", F.posexplode_outer("_w").alias("_pos", "word"))
    start = F.col("_pos") - F.col("at")
    # only the words of the place leave the stage, never the text's
    part = F.slice("_w", F.greatest(F.lit(0), start) + 1, F.greatest(F.lit(0), F.size("cwords") + F.least(F.lit(0), start)))
    hits = (
        spots.join(F.broadcast(postings), "word", "left")
        .where("at is not null or _pos is null or _pos = 0")
        .select("_row", "_key", F.size("_w").cast("long").alias("n_words"), "label", "base", "cwords", "must", "least", "before", start.alias("start"), F.when(F.col("at").isNotNull(), part).alias("_part"))
    )
    agrees = F.transform("cwords", lambda x, j: F.coalesce(F.get("_part", j + F.least(F.lit(0), F.col("start"))) == x, F.lit(False)))
    hits = hits.withColumn("_same", agrees)
    share = F.size(F.filter("_same", lambda x: x))
    whole = ~F.exists(F.arrays_zip("must", "_same"), lambda x: x["must"] & ~x["_same"]) & (share >= F.col("least"))
    alone = ~F.exists("before", lambda p: F.get("_same", p))
    return hits.select("_row", "_key", "n_words", "label", "base", F.col("start").cast("long").alias("start"), (share / F.size("cwords")).alias("share"), F.coalesce(whole & alone, F.lit(False)).alias("ok"))


def op12(docs: DataFrame) -> DataFrame:
    """The contract's columns, added up from the operator's places."""
    base = F.col("ok") & F.col("base")
    joined = lambda when: F.array_join(F.sort_array(F.collect_set(F.when(when, F.col("label")))), ",")
    return (
        _places(docs, "doc_id", "text", TEMPLATES, 0.8)
        .groupBy("_row")
        .agg(
            F.first("_key").alias("doc_id"), F.first("n_words").alias("n_words"), F.count_if(base).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
            joined(base).alias("base_labels"), joined(F.col("ok")).alias("labels"), F.coalesce(F.max(F.when(F.col("ok"), F.col("share"))), F.lit(0.0)).alias("score"),
        )
        .drop("_row")
    )


def _values() -> str:
    rows = []
    for k, c in enumerate(TEMPLATES):
        n = len(c.words)
        rows += [f"({k}, '{c.label}', {c.base}, {j}, '{w}', {m}, {sum(c.must)}, {n}, {n - int(n * 0.2 + 1e-9)})" for j, (w, m) in enumerate(zip(c.words, c.must, strict=True))]
    return ", ".join(rows)


#: Without an index: every clause at every place, by counting the words that agree along each alignment.
ORACLE = rf"""
with d as (select row_number() over () rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_BETWEEN}'), lambda x: x <> '') w from documents),
x as (select rid, unnest(w) x, unnest(range(len(w))) i from d),
c(clause, label, base, j, x, must, musts, n, least) as (values {_values()}),
place as (select rid, clause, label, base, i - j s, count(*) / any_value(n) as share from x join c using (x) group by rid, clause, label, base, i - j
  having count(*) >= any_value(least) and count(*) filter (must) = any_value(musts)),
told as (select rid, count(*) filter (base) n_base, min(s) filter (base) first_word, max(s) filter (base) last_word,
  array_to_string(list_sort(list(distinct label) filter (base)), ',') base_labels, array_to_string(list_sort(list(distinct label)), ',') labels, max(share) score from place group by rid)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0) as score from d left join told using (rid)
"""
