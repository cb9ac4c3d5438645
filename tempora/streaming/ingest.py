"""Bronze load (C1) as an incremental file stream.

The study reloads every raw file with a full overwrite. When the landing
folder only grows, the same load can run as a Structured Streaming query
with an ``availableNow`` trigger: each run picks up only files not seen
before (tracked in the checkpoint), writes them with the same all-string
schema and lineage columns, and stops. Exactly-once into the parquet sink;
a lost executor or a failed run resumes from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tempora.sources.ingest import LINEAGE_FILE, LINEAGE_TS, string_schema


def ingest_available_now(spark: SparkSession, landing: str, fmt: str, columns: Sequence[str],
                         target: str, checkpoint: str | None = None, **options):
    """Load new raw files from ``landing`` into the parquet folder ``target``;
    returns the finished ``StreamingQuery``. ``checkpoint`` defaults to a
    hidden folder of the target, so that every run into one target goes on
    where the last one stopped."""
    ckpt = checkpoint or f"{target.rstrip('/')}/_checkpoint"
    stream = (spark.readStream.format(fmt).schema(string_schema(columns)).options(**options)
              .load(landing)
              .withColumns({LINEAGE_FILE: F.col("_metadata.file_path"),
                            LINEAGE_TS: F.current_timestamp()}))
    q = (stream.writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
