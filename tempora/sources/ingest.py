"""Bronze ingest (C1, S1-S7): raw text files -> all-string DataFrame with
row-level lineage, plus the landing manifest check and the table sink.

Raw files are read with an explicit all-``StringType`` schema: no inference
pass over the data, and no type drift when a source stops quoting values.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE_FILE = "_arquivo_origem"
LINEAGE_TS = "_data_ingestao"


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _run_ts(run_ts) -> Column:
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts
    return F.lit(run_ts).cast("timestamp")


def with_lineage(df: DataFrame, run_ts=None) -> DataFrame:
    """Add the source-file path (hidden ``_metadata`` column of file sources)
    and the ingestion timestamp."""
    return df.withColumns({
        LINEAGE_FILE: F.col("_metadata.file_path"),
        LINEAGE_TS: _run_ts(run_ts),
    })


def ingest(spark: SparkSession, path: str | list[str], fmt: str, columns: Sequence[str],
           run_ts=None, **options) -> DataFrame:
    """Read raw text as-is (every column STRING) and add lineage columns.

    ``fmt`` is any file source (``json`` with ``multiLine='true'`` for one JSON
    array per file, ``csv`` with ``header='true'``...). Empty CSV cells come
    back as NULL. The read is lazy: nothing runs until an action.
    """
    reader = spark.read.format(fmt).schema(string_schema(columns)).options(**options)
    df = reader.load(path)
    return with_lineage(df, run_ts)


def manifest(spark: SparkSession, directory: str, expected: Iterable[str]) -> DataFrame:
    """Landing manifest (S1): one row per expected name with its file count
    and total size in bytes (NULL size when missing). A name is a file directly
    under ``directory`` or a folder of part files. Lists file metadata only
    (``content`` is never selected, so no file body is read)."""
    root = directory.rstrip("/")
    marker = root.split(":", 1)[-1] + "/"
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
               .select(F.split(F.expr(f"substring(path, instr(path, '{marker}') + {len(marker)})"), "/")[0]
                       .alias("arquivo"), "length")
               .groupBy("arquivo").agg(F.count("*").alias("arquivos"), F.sum("length").alias("bytes")))
    wanted = spark.createDataFrame([(e,) for e in expected], "arquivo string")
    # the expected-name list is a fixed, tiny driver-side list: broadcast is bounded
    return (F.broadcast(wanted).join(listing, "arquivo", "left")
            .select("arquivo", F.coalesce("arquivos", F.lit(0)).alias("arquivos"), "bytes",
                    F.col("bytes").isNotNull().alias("presente")))


def assert_manifest(manifest_df: DataFrame) -> None:
    """Raise if any expected file is missing (one tiny aggregate action)."""
    missing = manifest_df.filter(~F.col("presente")).agg(F.count("*").alias("n")).first()["n"]
    if missing:
        raise FileNotFoundError(f"{missing} expected landing file(s) missing")


def write_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by=None) -> None:
    """Managed-table sink (S7): full overwrite including schema; idempotent."""
    w = df.write.mode("overwrite").option("overwriteSchema", "true").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, **options) -> None:
    """Path sink: full overwrite of a folder (used for lineage cuts and the
    text landing files written from tables)."""
    w = df.write.mode("overwrite").format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, stacked (S16/A2/D12): one ``count(*)`` per input,
    unioned into a single plan and run as one job."""
    parts = [df.agg(F.count("*").alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
