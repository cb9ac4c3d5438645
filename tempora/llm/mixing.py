"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key; within a source the documents are
sorted by that key, their word counts are summed up by distributed prefix
sums, and the source is cut at its exact budget, in as many epochs as the
budget needs.

Defined results: a null text has size 0 and is never taken; a null source is
a source of its own, the last in order; an empty table gives an empty result;
rows that repeat are taken as often as they stand, by the order of their keys
(equal rows are interchangeable). Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.prefix import prefix_sums
from tempora.llm.text import attach, materialise, read_documents

SEPARATORS = r"[\x20\x09-\x0D]+"
WORD_ENDS = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    t = F.coalesce(text, F.lit(""))
    return F.size(F.filter(F.split(t, SEPARATORS), lambda w: w != "")).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, mix key and tie-break of every document, written once."""
    df = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                     F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")).alias("_key"),
                     F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_tie"))
    return materialise(df, "mix-sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source: its size, weight and target.

    Targets are ``level * weight``, held at ``repeats`` times the source's
    size; the level is the one at which they sum to ``share`` of all words.
    Sources sorted by the level at which they fill up are full up to some
    place in that order, so prefix sums over the sources (one row each) find it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = (per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                 (rank % len(weights) + 1).cast("int")))
           .withColumn("cap", (F.col("source_size") * repeats).cast("double")))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy(F.lit(0))
    per = (per.withColumn("_full", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
           .withColumn("_open", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
           .withColumn("_want", F.sum("source_size").over(whole) * F.lit(share))
           .withColumn("_level", (F.col("_want") - F.col("_full")) / F.col("_open"))
           # the first source in filling order that the level leaves open
           .withColumn("_lambda", F.min(F.when(F.col("_level") * F.col("weight") <= F.col("cap"),
                                               F.struct(F.col("cap") / F.col("weight"), "_level"))).over(whole)["_level"]))
    return per.select("source", "source_size",
                      F.least("cap", F.coalesce(F.col("_lambda") * F.col("weight"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and the document's
    place (words before it) in its source's order, per document.

    ``taken`` counts the words the mix takes from the document: its size for
    every whole epoch, and in the last epoch what the budget leaves after the
    documents before it (the document at the cut gives its first words)."""
    s = sized(docs)
    per = materialise(targets(s, weights, share, repeats), "mix-targets").withColumnRenamed("source", "_src")
    placed = prefix_sums(s, "source", "_key", ["_tie", "size"], F.col("size"), "place")
    budget = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    return (placed.join(per, F.col("source").eqNullSafe(F.col("_src")), "inner").drop("_src")
            .withColumn("epochs", epochs.cast("long"))
            .withColumn("part", F.least("size", F.greatest(F.lit(0), budget - F.col("epochs") * F.col("source_size") - F.col("place"))).cast("long"))
            .withColumn("taken", (F.col("epochs") * F.col("size") + F.col("part")).cast("long")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken whole, and the
    one at its source's cut with its first words; the columns of ``docs``."""
    full = (F.col("part") >= F.col("size")) & (F.col("size") > 0)
    m = mix(docs).select(F.col("doc_id").alias("_id"), F.col("source").alias("_s"), F.col("_tie").alias("_t"),
                         (F.col("epochs") + F.when(full, 1).otherwise(0)).alias("w"), F.when(~full & (F.col("part") > 0), F.col("part")).alias("p"), "size")
    # rows that share id, source and text are interchangeable: one of them stands for all
    m = m.groupBy("_id", "_s", "_t").agg(F.sum(F.when(F.col("size") > 0, F.col("w")).otherwise(0)).alias("whole"), F.collect_list("p").alias("heads"), F.count("*").alias("rows"))
    m = materialise(m.filter((F.col("whole") > 0) | (F.size("heads") > 0)), "mix-copies")
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text", F.md5(text.cast("binary")).alias("_tie"))
    j = attach(d, m, lambda x, y: x.doc_id.eqNullSafe(y["_id"]) & x.source.eqNullSafe(y["_s"]) & (x["_tie"] == y["_t"]))
    j = j.select("_row", "text", "whole", "heads", "rows", "_id", "_s", "_t")
    if not m.filter("rows > 1").isEmpty():
        one = Window.partitionBy("_id", "_s", "_t").orderBy(F.xxhash64("_row"))
        j = j.filter("rows = 1").unionByName(j.filter("rows > 1").withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n"))
    copies = F.concat(F.array_repeat(F.lit(None).cast("long"), F.col("whole").cast("int")), "heads")
    out = j.withColumn("_cut", F.explode(copies))
    # pieces that end with a word each, separators kept
    head = F.array_join(F.slice(F.split("text", WORD_ENDS), 1, F.col("_cut").cast("int")), "")
    out = out.withColumn("text", F.when(F.col("_cut").isNotNull(), head).otherwise(F.col("text")))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
