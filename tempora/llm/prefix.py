"""Distributed prefix sums with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group that one task orders at once.
ROWS_PER_RANGE = 4_096


def unit(hex_key: Column) -> Column:
    """A number in [0, 1) from the first eight hexadecimal digits."""
    return F.conv(F.substring(hex_key, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def prefix_sums(df: DataFrame, group: str, key: str, ties: list[str], weight: Column, out: str,
                rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``out``: the sum of ``weight`` over the rows of the same ``group``
    that sort before this one by ``key`` (hexadecimal hash) and ``ties``.

    Each group's hash range is cut into as many ranges as its row count needs,
    so a group with a third of all rows is ordered by many tasks. Totals by
    (group, range) are summed up in a window over ranges alone, and joined
    back; rows are ordered within their range only. ``group`` may be null.
    """
    g = F.col(group)
    sizes = df.groupBy(g.alias("_g")).agg(F.count("*").alias("_rows"))
    cut = (df.withColumn("_w", weight)
           .join(sizes, g.eqNullSafe(F.col("_g")), "inner").drop("_g")
           .withColumn("_r", F.floor(unit(F.col(key)) * F.ceil(F.col("_rows") / rows_per_range)).cast("int"))
           .drop("_rows"))
    totals = cut.groupBy(g.alias("_g"), F.col("_r").alias("_rr")).agg(F.sum("_w").alias("_t"))
    before = Window.partitionBy("_g").orderBy("_rr").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_g", "_rr", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_r").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (cut.join(totals, g.eqNullSafe(F.col("_g")) & (F.col("_r") == F.col("_rr")), "inner").drop("_g", "_rr")
            .withColumn(out, F.col("_base") + F.coalesce(F.sum("_w").over(inside), F.lit(0)))
            .drop("_base", "_w", "_r"))
