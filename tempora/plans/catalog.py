"""Catalog and data dictionary (S12-S15, C20): layer schemas with comments,
table comments and per-column comments driven from dicts, with the
per-horizon entries generated from templates.

Only catalog DDL runs here (driver <-> catalog); no data moves. Comment text
is escaped before it is put into SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.plans.series_catalogue import HORIZONS


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_schema(spark: SparkSession, name: str, comment: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` with a comment (S12); ``location``
    places it in a shared folder instead of the warehouse default."""
    loc = f" LOCATION {_q(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_ident(name)} COMMENT {_q(comment)}{loc}")


def comment_schema(spark: SparkSession, name: str, comment: str) -> None:
    """``COMMENT ON SCHEMA``."""
    spark.sql(f"COMMENT ON SCHEMA {_ident(name)} IS {_q(comment)}")


def list_schemas(spark: SparkSession) -> DataFrame:
    """``SHOW SCHEMAS`` as a DataFrame."""
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """``SHOW TABLES IN`` as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN {_ident(schema)}")


def document(spark: SparkSession, table: str, comment: str | None = None,
             columns: dict[str, str] | None = None) -> None:
    """Table comment (S14) and one ``ALTER COLUMN ... COMMENT`` per column
    present in the table (S15)."""
    if comment:
        spark.sql(f"COMMENT ON TABLE {_ident(table)} IS {_q(comment)}")
    present = set(spark.table(table).columns)
    for col, text in (columns or {}).items():
        if col in present:
            spark.sql(f"ALTER TABLE {_ident(table)} ALTER COLUMN `{col}` COMMENT {_q(text)}")


def horizon_comments(templates: dict[str, str],
                     horizons: Sequence[tuple[int, int]] = HORIZONS) -> dict[str, str]:
    """Expand ``{dc}``-templated column names and texts once per horizon."""
    out: dict[str, str] = {}
    for _, dc in horizons:
        for name, text in templates.items():
            out[name.format(dc=dc)] = text.format(dc=dc)
    return out


def columns(spark: SparkSession, table: str) -> DataFrame:
    """(coluna, tipo, comentario) as recorded in the catalog."""
    return spark.sql(f"DESCRIBE TABLE {_ident(table)}").select(
        F.col("col_name").alias("coluna"), F.col("data_type").alias("tipo"), F.col("comment").alias("comentario"))


def column_comments(spark: SparkSession, table: str) -> DataFrame:
    """Column name -> comment as recorded in the catalog."""
    return spark.sql(f"DESCRIBE TABLE {_ident(table)}").select("col_name", "comment")
