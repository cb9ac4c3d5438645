"""Corpus pipeline: language ID, near duplicates, benchmark decontamination,
mixing to target weights, sharding.

Each stage works on all rows that the stage before it kept; its result is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempora.llm.decontaminate import clean_documents
from tempora.llm.jaccard import unique_documents
from tempora.llm.langid import accepted_documents
from tempora.llm.mixing import mixed_documents
from tempora.llm.sharding import sharded_documents
from tempora.llm.text import materialise, read_documents


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go: those with null or empty text or
    without a letter, and all where no document teaches a language (a null
    lang or doc_id teaches nothing). Rows are judged one by one, repeated ones
    alike; an empty table stays empty; all columns are kept as they are."""
    return accepted_documents(docs)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles,
    similarity 0.8): that of the smallest doc_id, null last; of rows that share
    it and the set, the smallest text, once. Null, empty and word-less texts
    are in no group and all stay. An empty table stays empty; all columns are
    kept as they are, names of the operator's own included."""
    return unique_documents(docs)


def stage_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go. Null and word-less texts hold
    none and stay; repeated rows are judged alike; with an empty benchmark all
    stay; an empty table stays empty; all columns are kept as they are."""
    return clean_documents(docs, read_documents(spark, sf_dir, "benchmark"))


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source (null is one of its own) is repeated or cut to its target.
    Texts without words are not taken; of the text at a source's cut the first
    words are. ``n_chars``, where there is such a column, is the length of the
    text that is taken, also where the input said otherwise; other columns are
    kept as they are. Rows of one doc_id, source and text are interchangeable.
    An empty table stays empty."""
    return mixed_documents(docs)


def stage_shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its ``shard`` by the jump hash of its doc_id (null is 0),
    in the place of a column of that name; equal doc_ids share one. An empty
    table stays empty; the other columns are kept as they are."""
    return sharded_documents(docs)


STAGES = [
    ("language", stage_language),
    ("near_duplicates", stage_near_duplicates),
    ("benchmark", stage_benchmark),
    ("mix", stage_mix),
    ("shard", stage_shard),
]

#: Language ID and the similarity join are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
