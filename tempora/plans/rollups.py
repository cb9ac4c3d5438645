"""Queries from stored states over the local test tables: quantile cuts from
monthly sketches, distinct keys from monthly bitmaps, z-scores from daily
moments, and a range check in SQL with its bounds as parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators import states as S
from tempora.plans import study
from tempora.plans.series_catalogue import RANGE_BOUNDS
from tempora.session import cut_lineage
from tempora.sources.fixtures import read_table

FRACTIONS = (1 / 3, 2 / 3)
RANK_ERROR = 0.001
PERIOD = ("2024-01-08", "2024-01-21")
Z_LIMIT = 1.7
SINCE = dt.date(1998, 1, 1)


def regime_cuts_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regime cuts (1/3, 2/3) of the item prices of each return flag, merged
    from one stored sketch a month, and whether either cut's exact rank is
    within the promised error."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", F.trunc(F.to_date("l_shipdate"), "month").alias("mes"), "l_extendedprice")
    stored = cut_lineage(S.quantile_sketches(li, ["l_returnflag", "mes"], "l_extendedprice"), "sketches")
    cuts = S.merged_cuts(stored, ["l_returnflag"], FRACTIONS)
    months = stored.groupBy("l_returnflag").agg(F.count("*").alias("meses"))
    # one row per return flag
    cuts = cut_lineage(cuts.join(months, "l_returnflag").withColumnRenamed("l_returnflag", "_flag"), "cuts")
    x = F.col("l_extendedprice")
    ranked = li.join(cuts, F.col("l_returnflag") == F.col("_flag")).groupBy("l_returnflag", "n", "meses").agg(
        *[F.count_if(op).alias(name) for i in range(len(FRACTIONS)) for name, op in ((f"lt{i}", x < F.col("cuts")[i]), (f"le{i}", x <= F.col("cuts")[i]))])
    ok = [((F.col(f"lt{i}") / F.col("n") <= f + RANK_ERROR) & (F.col(f"le{i}") / F.col("n") >= f - RANK_ERROR)).alias(f"corte{i + 1}_ok") for i, f in enumerate(FRACTIONS)]
    return ranked.select("l_returnflag", F.col("n").alias("linhas"), "meses", *ok)


def distinct_orders_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct orders shipped, per year, from one stored set of bitmaps a month."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", F.trunc(F.to_date("l_shipdate"), "month").alias("mes"))
    stored = cut_lineage(S.distinct_bitmaps(li, ["mes"], F.col("l_orderkey")), "bitmaps")
    return S.merged_distinct(stored.withColumn("ano", F.year("mes")), ["ano"], "pedidos")


def unique_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 on a table whose key does repeat: rows, distinct (order, line) pairs
    and surplus rows per return flag, the pairs counted by bitmaps instead of an
    expanding distinct aggregate."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    pairs = S.merged_distinct(S.distinct_bitmaps(li, ["l_returnflag"], S.paired("l_orderkey", "l_linenumber", 8)), ["l_returnflag"], "chaves")
    rows = li.groupBy("l_returnflag").agg(F.count("*").alias("linhas"))
    return rows.join(pairs, "l_returnflag").withColumn("duplicadas", F.col("linhas") - F.col("chaves"))


def zscore_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 for any period from stored daily states: the events of the period
    whose z-score, by the merged mean and deviation of their type, exceeds the limit."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("dia"), "value")
    stored = cut_lineage(S.moment_states(ev, ["event_type", "dia"], "value"), "moments")
    inside = F.col("dia").between(*[F.lit(d).cast("date") for d in PERIOD])
    merged = S.merge_moments(stored.filter(inside), ["event_type"]).select(F.col("event_type").alias("_type"), "n", "mean", S.deviation().alias("sd"))
    rows = ev.filter(inside)
    z = F.try_divide(F.col("value") - F.col("mean"), F.col("sd"))
    return (rows.join(merged, F.col("event_type").eqNullSafe(F.col("_type"))).withColumn("z", z).filter(F.abs("z") > Z_LIMIT)
            .select("event_id", "event_type", "dia", F.col("n").alias("linhas_periodo"), F.round("z", 6).alias("z_score")))


def sql_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 in SQL over the published table: the bounds are an inline relation,
    and they and the first day are parameters of the statement."""
    study.published_silver(spark, sf_dir)
    args = {"desde": SINCE}
    for i, (code, low, high) in enumerate(RANGE_BOUNDS):
        args |= {f"c{i}": code, f"lo{i}": float(low), f"hi{i}": float(high)}
    listed = ", ".join(f"(:c{i}, :lo{i}, :hi{i})" for i in range(len(RANGE_BOUNDS)))
    return spark.sql(f"""
        SELECT l.indicador, l.minimo, l.maximo, count(s.valor) AS dias,
               count_if(s.valor NOT BETWEEN l.minimo AND l.maximo) AS fora_da_faixa
        FROM (VALUES {listed}) AS l(indicador, minimo, maximo)
        LEFT JOIN silver.serie_diaria s ON s.indicador = l.indicador AND s.data >= :desde
        GROUP BY l.indicador, l.minimo, l.maximo""", args=args)


QUERIES = {
    "regime_cuts_merged": regime_cuts_merged,
    "distinct_orders_merged": distinct_orders_merged,
    "unique_items": unique_items,
    "zscore_from_states": zscore_from_states,
    "sql_range_check": sql_range_check,
}
