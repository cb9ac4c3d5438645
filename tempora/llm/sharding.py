"""Sharding by jump consistent hashing, with DataFrame operations only.

The jump hash is the published one (Lamping and Veach): a linear congruential
generator seeded with the key jumps ahead through the shard numbers until it
leaves the range; no ring table is kept, and with one more shard a row either
stays or moves to the new shard. The 64-bit products are computed in
DECIMAL(38, 0), which holds them exactly.

Defined results: the law is ``key``; a null doc_id has key 0; a null text is
empty (size 1, checksum 0); rows with one doc_id share a shard. Slots number
each shard's rows from 0 by md5 of the doc_id, then doc_id, md5 of the text;
equal rows take neighbouring slots. An empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.prefix import prefix_sums
from tempora.llm.text import materialise, read_documents

SHARDS = 8
#: fixed values of the published jump hash
MULTIPLIER = 2862933555777941757
TWO_64 = 1 << 64
TWO_33 = 1 << 33
TWO_31 = 1 << 31


def jump_columns(df: DataFrame, key: Column, shards: int, out: str, grown: str | None = None) -> DataFrame:
    """Adds ``out``, the shard among ``shards``, and ``grown``, that among one more."""
    dec = "decimal(38,0)"
    wrap = F.lit(str(TWO_64)).cast(dec)
    state = F.pmod(key.cast(dec), wrap).cast(dec)
    most = shards + (1 if grown else 0)
    df = df.withColumn("_k", state).withColumn("_b", F.lit(0).cast("long")).withColumn("_j", F.lit(0).cast("long")).withColumn("_at", F.lit(0).cast("long"))
    for _ in range(most):  # every jump goes ahead by one shard at least
        go = F.col("_j") < most
        df = (df.withColumn("_k", F.when(go, F.pmod(F.col("_k").cast("decimal(20,0)") * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1), wrap).cast(dec)).otherwise(F.col("_k")))
              .withColumn("_at", F.when(F.col("_j") < shards, F.col("_j")).otherwise(F.col("_at")))
              .withColumn("_b", F.when(go, F.col("_j")).otherwise(F.col("_b")))
              .withColumn("_j", F.when(go, F.floor((F.col("_b") + 1).cast("double") * (F.lit(float(TWO_31)) / (F.floor(F.col("_k") / F.lit(TWO_33).cast(dec)).cast("double") + 1.0)))).otherwise(F.col("_j"))))
    df = df.withColumn(out, F.when(F.col("_j") < shards, F.col("_j")).otherwise(F.col("_at")).cast("int"))
    if grown:
        df = df.withColumn(grown, F.col("_b").cast("int"))
    return df.drop("_k", "_b", "_j", "_at")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.md5(text).alias("_tie"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")).alias("_key"))
    rows = jump_columns(rows, F.coalesce(F.col("doc_id"), F.lit(0)), shards, "shard", "grown_shard")
    rows = materialise(rows, "shard-rows")
    return prefix_sums(rows, "shard", "_key", ["doc_id", "_tie"], F.lit(1).cast("long"), "slot").withColumn("law", F.lit("key"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read_documents(spark, sf_dir)).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def sharded_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The columns of ``docs`` and each row's ``shard`` (in the place of a column of that name)."""
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("_id"))
    rows = jump_columns(rows, F.col("_id"), shards, "_shard")
    return rows.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() != "shard"], F.col("_shard").alias("shard"))
