"""Landing files as the sources publish them, one file a year: JSON arrays and
CSV with a header, with records that cannot be read among the good ones.

An array file is not read by one task when it is large: ``read_json_arrays``
takes the file as text cut at the end of each object, which Spark splits like
any line file, and parses every piece by itself. Pieces that are no record go
to the quarantine (``columnNameOfCorruptRecord`` in permissive mode), with
their file, and are counted in the ledger of that file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.plans.series_catalogue import SERIES
from tempora.sources.fixtures import bronze_days
from tempora.sources.ingest import LINEAGE_FILE, LINEAGE_TS, string_schema, with_lineage

INVALID = "_registro_invalido"
#: fixed value: on days divisible by it a record that cannot be read is added
BROKEN_EVERY = 61


def _with_invalid(columns: Sequence[str]) -> T.StructType:
    return string_schema(columns).add(INVALID, "string")


def read_json_arrays(spark: SparkSession, path: str | list[str], columns: Sequence[str], run_ts=None) -> DataFrame:
    """JSON array files of flat objects: ``columns`` as text, lineage, and
    ``INVALID`` (the text of a piece that is no record, else NULL).

    Values must not hold ``}`` (dates and numbers do not): it ends a piece. A
    record without its own end takes the next one into quarantine with it; a
    file cut off inside its last record loses that record to quarantine, unless
    only the object's end is missing.
    Files of nested objects are for ``ingest(..., multiLine='true')``."""
    pieces = with_lineage(spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path), run_ts)
    body = F.regexp_replace("value", r"^[\s,\[\]]+", "")
    record = F.from_json(F.concat("_body", F.lit("}")), _with_invalid(columns),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": INVALID})
    return (pieces.withColumn("_body", body).filter(F.col("_body") != "").withColumn("_r", record)
            .select(*[F.col(f"_r.`{c}`").alias(c) for c in columns], LINEAGE_FILE, LINEAGE_TS, F.col(f"_r.{INVALID}").alias(INVALID)))


def read_csv_checked(spark: SparkSession, path: str | list[str], columns: Sequence[str], run_ts=None) -> DataFrame:
    """CSV files with a header: ``columns`` as text, lineage, and ``INVALID``
    (a line with another number of cells, else NULL). Lines that repeat the
    header are left out; cells do not hold line ends."""
    lines = with_lineage(spark.read.option("recursiveFileLookup", "true").text(path), run_ts)
    record = F.from_csv(F.col("value"), F.lit(_with_invalid(columns).toDDL()), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": INVALID})
    return (lines.filter(~F.col("value").isin("", ",".join(columns))).withColumn("_r", record)
            .select(*[F.col(f"_r.`{c}`").alias(c) for c in columns], LINEAGE_FILE, LINEAGE_TS, F.col(f"_r.{INVALID}").alias(INVALID)))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine)."""
    return df.filter(F.col(INVALID).isNull()).drop(INVALID), df.filter(F.col(INVALID).isNotNull()).select(INVALID, LINEAGE_FILE, LINEAGE_TS)


def file_name(path: Column) -> Column:
    """Table and year of a landing file, from its folder."""
    return F.concat(F.regexp_extract(path, "/tabela=([^/]+)/", 1), F.lit("/"), F.regexp_extract(path, "/ano=([^/]+)/", 1))


def render_landing_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write the six series as ``tabela=.../ano=.../`` files: JSON arrays where
    the catalogue's dates are dd/MM/yyyy, else CSV. A file holds one year."""
    days = bronze_days(spark, sf_dir)
    arrays = F.col("tabela").isin([s.table for s in SERIES if s.date_fmt == "dd/MM/yyyy"])
    head = F.create_map(*[F.lit(x) for s in SERIES for x in (s.table, f"{s.date_col},{s.value_col}")])
    value = F.coalesce("valor_txt", F.lit(""))
    good = F.when(arrays, F.to_json(F.struct(F.col("data_txt").alias("data"), F.col("valor_txt").alias("valor")))).otherwise(F.concat("data_txt", F.lit(","), value))
    bad = F.when(arrays, F.format_string('{"data":"%s","valor" "%s"}', "data_txt", value)).otherwise(F.concat("data_txt", F.lit(","), value, F.lit(",x")))
    # the broken record stands beside the day's own row (fault 0)
    rows = days.withColumn("linha", F.explode(F.when((F.col("dia") % BROKEN_EVERY == 0) & (F.col("falha") == 0), F.array(bad, good)).otherwise(F.array(good))))
    rows = rows.select("tabela", F.year(F.date_from_unix_date("dia")).alias("ano"), "dia", "falha", "linha")
    one = Window.partitionBy("tabela", "ano")
    n, last = F.row_number().over(one.orderBy("dia", "falha", "linha")), F.count("*").over(one)
    text = (F.when(arrays, F.concat(F.when(F.col("n") == 1, "[").otherwise(","), "linha", F.when(F.col("n") == F.col("last"), "]").otherwise("")))
            .otherwise(F.concat(F.when(F.col("n") == 1, F.concat(head[F.col("tabela")], F.lit("\n"))).otherwise(""), "linha")))
    (rows.withColumns({"n": n, "last": last}).select("tabela", "ano", "n", text.alias("value"))
     .repartition("tabela", "ano").sortWithinPartitions("tabela", "ano", "n").drop("n")
     .write.mode("overwrite").partitionBy("tabela", "ano").text(folder))


def read_landing_files(spark: SparkSession, folder: str, run_ts=None) -> DataFrame:
    """All six series: (tabela, data_txt, valor_txt, lineage, INVALID)."""
    parts = []
    for s in SERIES:
        read = read_json_arrays if s.date_fmt == "dd/MM/yyyy" else read_csv_checked
        raw = read(spark, f"{folder.rstrip('/')}/tabela={s.table}", [s.date_col, s.value_col], run_ts)
        parts.append(raw.select(F.lit(s.table).alias("tabela"), F.col(s.date_col).alias("data_txt"), F.col(s.value_col).alias("valor_txt"),
                                LINEAGE_FILE, LINEAGE_TS, INVALID))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
