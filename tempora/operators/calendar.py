"""Calendar source and time dimension.

The spine is built from a one-row ``agg(min, max)`` exploded with
``sequence`` -- no driver round-trip to splice dates into SQL text. Its size
is the number of days in the range, independent of the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.plans.series_catalogue import WEEKDAY_NAMES


def date_spine(df: DataFrame, col: str = "data", name: str = "data") -> DataFrame:
    """One row per calendar day between min(col) and max(col); empty input ->
    empty output."""
    lim = df.agg(F.min(col).alias("_ini"), F.max(col).alias("_fim"))
    return (lim.filter(F.col("_ini").isNotNull())
            .select(F.explode(F.sequence("_ini", "_fim", F.expr("INTERVAL 1 DAY"))).alias(name)))


def attributes(day: Column) -> dict[str, Column]:
    """Calendar attributes of a day."""
    return {
        "ano": F.year(day),
        "trimestre": F.quarter(day),
        "mes": F.month(day),
        "ano_mes": F.date_format(day, "yyyy-MM"),
        "semana_ano": F.weekofyear(day),
        "dia_semana": F.elt(F.dayofweek(day), *[F.lit(n) for n in WEEKDAY_NAMES]),
    }


def dim_time(spine: DataFrame, flag_dates: DataFrame, col: str = "data", flag: str = "eh_dia_util_ptax") -> DataFrame:
    """The spine's days with their ``attributes`` and whether ``flag_dates``
    has the day. Both sides are bounded by the calendar."""
    days = spine.withColumns(attributes(F.col(col)))
    listed = flag_dates.groupBy(F.col(col).alias("_listed")).agg(F.count("*").alias("_n"))
    return (days.join(listed, days[col] == F.col("_listed"), "left")
            .withColumn(flag, F.col("_n").isNotNull()).drop("_listed", "_n"))
