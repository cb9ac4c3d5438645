"""The study for many markets at once: the six series of every customer region,
each region with its own cleaning, calendar, windows and regimes.

All steps take the region as a key: the waterfall and its ledger, the daily
change, the alignment and the window fact. A key's rows go through the same
monthly summaries and ordered blocks as the one long series does, so a region
with most of the rows is no bigger task than another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import metrics as M
from tempora.operators.clean import waterfall
from tempora.plans import gold, study
from tempora.plans.series_catalogue import LEDGER_COLUMNS
from tempora.plans.study import round_doubles
from tempora.session import cut_lineage
from tempora.sources.fixtures import daily_series, read_table

KEY = "regiao"


def regional_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(regiao, indicador, data, valor): every series of every region, as observed."""
    t = lambda name: read_table(spark, sf_dir, name)
    place = (t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
             .select("n_nationkey", F.col("r_name").alias(KEY)))
    home = t("customer").select("c_custkey", "c_nationkey").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", KEY)
    orders = t("orders").join(home, F.col("o_custkey") == F.col("c_custkey"))
    items = t("lineitem").join(orders.select("o_orderkey", KEY), F.col("l_orderkey") == F.col("o_orderkey"))
    long = daily_series(spark, sf_dir, orders, items, [KEY])
    return long.select(KEY, "indicador", F.col("d").alias("data"), F.col("valor_txt").try_cast("decimal(18,6)").alias("valor"))


def regional_silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(Silver, ledger) by region and series; written once per session and input."""
    def build():
        clean, ledger = waterfall(regional_long(spark, sf_dir), [KEY, "indicador"], cutoff=gold.FIXTURE_CUTOFF, materialise=cut_lineage)
        return clean, ledger.select(KEY, *LEDGER_COLUMNS)
    return study.memo(spark, ("regional", sf_dir), build)


def ledger_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regional_silver(spark, sf_dir)[1]


def daily_change_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(gold.daily_fact(regional_silver(spark, sf_dir)[0], [KEY, "indicador"]))


def regional_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        return gold.wide_fact(regional_silver(spark, sf_dir)[0], keys=[KEY], materialise=cut_lineage)
    return study.memo(spark, ("regional-wide", sf_dir), build)


def wide_fact_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7-C19 by region: 36 columns and the key."""
    return round_doubles(regional_wide(spark, sf_dir))


def regime_outcome_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 by region: what followed a day of each regime, in the region's own regimes."""
    w = regional_wide(spark, sf_dir).filter("regime_vol IS NOT NULL AND maior_alta_90d_pct IS NOT NULL")
    rise = F.col("maior_alta_90d_pct")
    return w.groupBy(KEY, "regime_vol").agg(
        F.count("*").alias("dias"), F.round(F.avg(rise), 2).alias("media_maior_alta_90d"), F.round(F.max(rise), 2).alias("pior_caso_90d"),
        F.round(M.quantile("maior_alta_90d_pct", 0.95), 2).alias("p95_maior_alta_90d"),
        F.round(100 * F.avg(F.when(rise > 5, 1.0).otherwise(0.0)), 1).alias("pct_dias_alta_acima_5pct"))


QUERIES = {
    "ledger_by_region": ledger_by_region,
    "daily_change_by_region": daily_change_by_region,
    "wide_fact_by_region": wide_fact_by_region,
    "regime_outcome_by_region": regime_outcome_by_region,
}
