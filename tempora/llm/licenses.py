"""License scans by diagonal voting, with DataFrame operations only.

A template is a short phrase or a notice as a list of words. All rolling word
k-grams of the documents are hashed and joined to the templates' positions of
the same k-gram. A match at word d of a document and word t of a template votes
for the diagonal d - t, where the template would begin. Votes are compared word
by word (hashes only find them), and neighbouring diagonals are merged: a
template with ``slack`` s counts its votes in bands of 2 s diagonals that
overlap by half, so that words left out of or put into the text do not part it.
A band's share is the part of the template's words that its votes cover; a band
with at least ``need`` of them is a verified span.

A phrase has slack 0 and need 1: its band is one diagonal, on which all of its
k-grams must vote, so the verified spans are the places where its words stand
consecutively.

The texts are read once. Every row gets a number in that pass, which is written
with the few rows that open some template's k-gram; all later groups are by
that number, so copies of a text are rows like others and no key is hot. The
templates are a parameter; their size is checked before they are broadcast.

Defined results: a null or empty text has no words, no places, labels '' and
score 0; first_word and last_word are null without a place; the score is the
highest share of any template, verified or not, so 1 where a phrase stands;
equal rows each get their row; an empty table gives no rows; other columns are
not read. Upper-case letters other than A-Z are not folded into a-z.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.text import materialise, read_documents

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: template words that may be broadcast
MOST_WORDS = 100_000
#: the one letter whose lower case is in a-z, and a letter that stands for it
KELVIN, OTHER = "\u212a", "\u00e5"


class Template(NamedTuple):
    label: str
    text: str
    k: int = 3
    slack: int = 8
    need: float = 0.6
    base: bool = False


#: fixed values: phrases that name a license
PHRASES = [
    Template("mit", "mit license", 2, 0, 1.0, True),
    Template("apache", "apache license", 2, 0, 1.0, True),
    Template("gpl", "general public license", 2, 0, 1.0, True),
]
#: fixed values: openings of public license notices
NOTICES = [
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
             "you may obtain a copy of the license at"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("cc-by", "this work is licensed under a creative commons attribution license"),
    Template("cc-by-nc", "licensed under cc by nc", 3, 0, 1.0),
    Template("cc-by-sa", "licensed under cc by sa", 3, 0, 1.0),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
             "as published by the free software foundation"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
]
TEMPLATES = PHRASES + NOTICES


def words_of(text: Column) -> Column:
    """The words of a text lower-cased in A-Z; other letters may be folded, but never into a-z."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(OTHER))
    return F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0))


def positions(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(k, gram, template, tpos, label, base, slack, need, size): every k-gram of every template."""
    rows, words = [], 0
    for i, t in enumerate(templates):
        w = re.findall("[a-z0-9]+", t.text)
        words += len(w)
        if t.k not in (2, 3) or len(w) < t.k or " ".join(w) != t.text:
            raise ValueError(f"template {i} ({t.label}): words of a-z and 0-9, at least k, k 2 or 3")
        rows += [(t.k, " ".join(w[p:p + t.k]), i, p, t.label, t.base, t.slack, t.need, len(w)) for p in range(len(w) - t.k + 1)]
    if words > MOST_WORDS:
        raise ValueError(f"{words} template words: more than {MOST_WORDS} are not broadcast")
    return spark.createDataFrame(rows, "k int, gram string, template int, tpos int, label string, base boolean, slack int, need double, size int")


def openings(docs: DataFrame, at: DataFrame) -> DataFrame:
    """(rid, doc_id, n_words, pos, w1, w2, w3): a row at pos -1 for every document, and one for every place whose two words open a template's k-gram."""
    lead = F.split("gram", " ")
    leads = at.select(F.xxhash64(lead[0], lead[1]).alias("lead")).unionByName(docs.sparkSession.range(1).select(F.xxhash64(F.lit(-1)).alias("lead"))).distinct()
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", words_of(F.col("text")).alias("words"))
    rows = rows.select("rid", "doc_id", "words", F.size("words").cast("long").alias("n_words"),
                       F.explode(F.sequence(F.lit(-1), F.greatest(F.size("words") - 2, F.lit(-1)))).alias("pos"))
    word = lambda i: F.when(F.col("pos") >= 0, F.get("words", F.col("pos") + i))
    rows = rows.select("rid", "doc_id", "n_words", "pos", *(word(i).alias(f"w{i + 1}") for i in range(3)))
    hashed = rows.withColumn("lead", F.when(F.col("pos") < 0, F.xxhash64(F.lit(-1))).otherwise(F.xxhash64("w1", "w2")))
    return hashed.join(F.broadcast(leads), "lead").drop("lead")


def spans(opened: DataFrame, at: DataFrame) -> DataFrame:
    """(rid, template, band, label, base, need, share): votes of every band, merged."""
    grams = opened.filter("pos >= 0").select("rid", "pos", F.explode(F.array(
        *(F.struct(F.lit(k).alias("k"), F.concat_ws(" ", *(f"w{i + 1}" for i in range(k))).alias("gram"),
                   F.xxhash64(*(f"w{i + 1}" for i in range(k))).alias("hash")) for k in (2, 3)))).alias("g")).select("rid", "pos", "g.*")
    word = F.split("gram", " ")
    keyed = at.withColumn("hash", F.when(F.col("k") == 2, F.xxhash64(word[0], word[1])).otherwise(F.xxhash64(word[0], word[1], F.get(word, F.lit(2))))).withColumnRenamed("gram", "want")
    votes = grams.join(F.broadcast(keyed), ["k", "hash"]).filter("gram = want").withColumn("diagonal", F.col("pos") - F.col("tpos"))
    first = F.floor(F.col("diagonal") / F.col("slack")).cast("int")
    bands = votes.withColumn("band", F.explode(F.when(F.col("slack") > 0, F.array(first, first + 1)).otherwise(F.array("diagonal"))))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + F.col("k") - 1)))))
    return (bands.groupBy("rid", "template", "band", "k", "label", "base", "need", "size").agg(F.collect_set("tpos").alias("at"))
            .select("rid", "template", "band", "label", "base", "need", (covered / F.col("size")).alias("share")))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document (doc_id, text)."""
    at = positions(docs.sparkSession, templates)
    opened = materialise(openings(docs.select("doc_id", "text"), at), "license-openings")
    found = F.col("share") >= F.col("need")
    base = found & F.col("base")
    joined = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    per = spans(opened, at).groupBy("rid").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("band"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("band"))).cast("long").alias("last_word"), joined(base).alias("base_labels"), joined(found).alias("labels"),
        F.max("share").alias("score"))
    return (opened.filter("pos < 0").join(per, "rid", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_documents(spark, sf_dir))
