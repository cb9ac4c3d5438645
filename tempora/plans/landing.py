"""Queries over the landing files by table and year: arrays and CSV read back
with their lineage, the quarantine, the manifest, and the ledger of each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators.clean import ledger_by_source, normalise_long
from tempora.plans import gold, study
from tempora.plans.series_catalogue import SERIES
from tempora.session import cut_lineage
from tempora.sources.arrays import INVALID, file_name, read_landing_files, split_quarantine
from tempora.sources.ingest import LINEAGE_FILE, LINEAGE_TS, manifest


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing_files(spark, study.landing_files(spark, sf_dir), gold.FIXED_RUN_TS)


def bronze_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the array files, each with its file and load time."""
    arrays = [s.table for s in SERIES if s.date_fmt == "dd/MM/yyyy"]
    good, _ = split_quarantine(_read(spark, sf_dir).filter(F.col("tabela").isin(arrays)))
    return good.select("tabela", file_name(F.col(LINEAGE_FILE)).alias("arquivo"), "data_txt", "valor_txt",
                       F.date_format(LINEAGE_TS, "yyyy-MM-dd HH:mm:ss").alias("ingestao"))


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all files that cannot be read, each with its file."""
    _, bad = split_quarantine(_read(spark, sf_dir))
    name = file_name(F.col(LINEAGE_FILE))
    return bad.select(F.split(name, "/")[0].alias("tabela"), name.alias("arquivo"), F.col(INVALID).alias("registro"))


def ledger_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every record, per series and file."""
    raw = _read(spark, sf_dir)
    typed = normalise_long(raw, SERIES, keep=[file_name(F.col(LINEAGE_FILE)).alias("arquivo"), F.col(INVALID)])
    return ledger_by_source(typed, ["indicador"], ["arquivo"], cutoff=gold.FIXTURE_CUTOFF, unreadable=F.col(INVALID).isNotNull(), materialise=cut_lineage)


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which expected tables have landed, with their number of files; one is expected in vain."""
    names = [*(s.table for s in SERIES), "bcb_selic"]
    found = manifest(spark, study.landing_files(spark, sf_dir), [f"tabela={n}" for n in names])
    return found.select(F.regexp_extract("arquivo", "=(.+)", 1).alias("arquivo"), "arquivos", "presente")


QUERIES = {
    "bronze_json_arrays": bronze_json_arrays,
    "bronze_quarantine": bronze_quarantine,
    "ledger_by_file": ledger_by_file,
    "landing_manifest": landing_manifest,
}
