"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is one of words (``kneser_ney``), trained on the trusted texts
(labels quality 1, toxic 0); counting, discounts and scoring are joins and
aggregates on n-gram keys.

Every document's perplexity is taken over its whole text. The threshold of a
language is the ``QUANTILE`` of its trusted documents' perplexities (a
histogram of log perplexities in steps of ``STEP``, so no task gathers them),
however many they are. ``keep`` is perplexity <= threshold.

Defined results: a text without a word (null and empty included) has no
perplexity (null) and is not kept; a null language is a language of its own;
a language without a trusted document that has a perplexity has no threshold
(null) and keeps nothing; labels count once per doc_id (any toxic or
non-quality label makes a document untrusted); texts whose other half holds no
trusted text have no perplexity and are not kept; repeated rows each get their
row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.kneser_ney import lookup, perplexities
from tempora.llm.text import attach, materialise, read_documents

QUANTILE = 0.99
STEP = 0.001


def quantiles(scored: DataFrame, q: float = QUANTILE) -> DataFrame:
    """(_lang, log_limit) of every language with a trusted document that has a perplexity, from the histogram of these."""
    bins = scored.filter("trusted and log_ppl is not null").groupBy("lang", F.ceil(F.col("log_ppl") / STEP).alias("bin")).agg(F.count("*").alias("n"))
    by = Window.partitionBy("lang")
    h = bins.withColumn("cum", F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(by))
    limit = h.filter(F.col("cum") >= F.ceil(F.col("total") * q)).groupBy("lang").agg(F.round(F.min("bin") * STEP, 6).alias("log_limit"))
    return materialise(limit.withColumnRenamed("lang", "_lang"), "kn-limits")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, trusted, perplexity, threshold and keep of every document."""
    good = materialise(labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).filter("q = 1 and t = 0 and doc_id is not null")
                       .select(F.col("doc_id").alias("_id")), "kn-trusted")
    n = good.count()
    docs = docs.select("doc_id", "lang", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    good = good.withColumn("trusted", F.lit(True))
    flagged = attach(docs.select("doc_id", "key", "text"), good, lambda d, g: d.doc_id == g["_id"], "left", rows=n)
    ppl = perplexities(docs, flagged.select("key", "text", F.coalesce("trusted", F.lit(False)).alias("trains")))
    rows = attach(docs.select("doc_id", "lang", "key"), good, lambda d, g: d.doc_id == g["_id"], "left", rows=n)
    scored = materialise(lookup(rows, ppl, ["key"]).select("doc_id", "lang", F.coalesce("trusted", F.lit(False)).alias("trusted"), "log_ppl"), "kn-scores")
    log_limit = F.col("log_limit")
    return (scored.join(quantiles(scored), F.col("lang").eqNullSafe(F.col("_lang")), "left")
            .select("doc_id", "lang", "trusted", F.exp("log_ppl").alias("perplexity"), F.exp(log_limit).alias("threshold"),
                    F.coalesce(F.col("log_ppl") <= log_limit, F.lit(False)).alias("keep")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "labels"))
