"""Data-quality checks (D1-D12) as DataFrame -> DataFrame operators.

Each check is one aggregate pass (partial + final aggregation) or an
anti-join; results are small report frames. Lookup sides that are tiny by
construction (one row per indicator, a bounds list) are broadcast; facts are
never broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.plans.series_catalogue import LEDGER_RULES


def reconcile(ledger: DataFrame, fact: DataFrame, keys: Sequence[str] = ("indicador",)) -> DataFrame:
    """Bronze - discards - silver (expect 0) and silver - gold (expect 0)
    per key."""
    keys = list(keys)
    gold = fact.groupBy(*keys).agg(F.count("*").alias("linhas_gold"))
    discards = sum((F.col(r) for r in [*LEDGER_RULES, "duplicadas"]), F.lit(0))
    return (ledger.join(gold, keys, "inner")
            .select(*keys, "linhas_bronze", discards.alias("descartadas"), "linhas_silver",
                    (F.col("linhas_bronze") - discards - F.col("linhas_silver")).alias("diferenca_bronze_silver"),
                    "linhas_gold",
                    (F.col("linhas_silver") - F.col("linhas_gold")).alias("diferenca_silver_gold")).orderBy(*keys))


def grain_counts(named: dict[str, DataFrame]) -> DataFrame:
    """Several scalar counts side by side in one row (one uncorrelated
    scalar subquery per count, no join)."""
    items = list(named.items())
    first_name, first = items[0]
    out = first.agg(F.count("*").alias(first_name))
    for name, df in items[1:]:
        out = out.withColumn(name, df.agg(F.count("*")).scalar())
    return out


def null_profile(df: DataFrame, total_name: str = "linhas") -> DataFrame:
    """D3: NULL count and % for every column, one aggregate pass, then
    unpivoted in Spark: ``(coluna, nulos, pct_nulos)``."""
    cols = df.columns
    agg = df.agg(F.count("*").alias("_total"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{i}") for i, c in enumerate(cols)])
    stacked = agg.select("_total", F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(f"n_{i}").alias("nulos")) for i, c in enumerate(cols)
    ])).alias("s"))
    return stacked.select(
        "s.coluna", "s.nulos",
        F.round(F.try_divide(100 * F.col("s.nulos"), F.col("_total")), 2).alias("pct_nulos")).orderBy(F.desc("nulos"), "coluna")


def uniqueness(named: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """COUNT(*) - COUNT(DISTINCT grain) per table (rows with a NULL grain
    part are not counted as distinct)."""
    parts = []
    for name, (df, grain) in named.items():
        parts.append(df.agg((F.count("*") - F.count_distinct(*[F.col(g) for g in grain]))
                            .alias("duplicadas")).select(F.lit(name).alias("tabela"), "duplicadas"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphans(relations: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Rows of a fact whose key has no match in a dimension (left anti
    join), one count per relation."""
    parts = []
    for name, (fact, dim, key) in relations.items():
        n = (fact.select(key).join(dim.select(key), key, "left_anti")
             .agg(F.count("*").alias("orfaos")))
        parts.append(n.select(F.lit(name).alias("relacao"), "orfaos"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def range_check(series: DataFrame, bounds: DataFrame, key: str = "indicador",
                value: str = "valor") -> DataFrame:
    """Observed min/max and count of values outside [min, max] per key.
    ``bounds``: (key, minimo_esperado, maximo_esperado), one row per key."""
    j = series.join(bounds, key, "inner")
    outside = ~F.col(value).between(F.col("minimo_esperado"), F.col("maximo_esperado"))
    return (j.groupBy(key, "minimo_esperado", "maximo_esperado")
            .agg(F.min(value).alias("minimo_obs"), F.max(value).alias("maximo_obs"),
                 F.sum(F.when(outside, 1).otherwise(0)).alias("fora_da_faixa")).orderBy(key))


def gaps(series: DataFrame, keys: Sequence[str] = ("indicador",), date: str = "data",
         threshold: int = 4) -> DataFrame:
    """Largest gap in days between consecutive observations and the
    number of gaps above ``threshold`` per key (keyed lag: one row per day per
    key, bounded by the calendar)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(date)
    g = series.select(*keys, F.datediff(F.col(date), F.lag(date).over(w)).alias("intervalo"))
    return g.groupBy(*keys).agg(
        F.max("intervalo").alias("maior_intervalo_dias"),
        F.sum(F.when(F.col("intervalo") > threshold, 1).otherwise(0)).alias("intervalos_acima_4_dias")).orderBy(*keys)


def publication_lag(series: DataFrame, reference: str, key: str = "indicador",
                    date: str = "data") -> DataFrame:
    """Last date per key and how many days it trails the reference
    series' last date (an uncorrelated scalar subquery)."""
    ref_last = series.filter(F.col(key) == reference).agg(F.max(date)).scalar()
    last = series.groupBy(key).agg(F.max(date).alias("ultima_data"))
    return last.select(key, "ultima_data",
                       F.datediff(ref_last, F.col("ultima_data")).alias("dias_atras_da_ptax")).orderBy(F.desc("dias_atras_da_ptax"), key)


def zscore_outliers(fact: DataFrame, key: str = "indicador", value: str = "variacao_pct",
                    codes: Sequence[str] | None = None, threshold: float = 5.0,
                    top: int = 20, extra: Sequence[Column] = (), ties: Sequence[str] = ()) -> DataFrame:
    """Per-key mean / sample stddev of ``value``; rows with |z| >
    threshold, largest |z| first, top ``top`` (a top-k report: the limit is the
    feature). Per-key stats are one row per key."""
    f = fact if codes is None else fact.filter(F.col(key).isin(list(codes)))
    stats = f.groupBy(key).agg(F.avg(value).alias("_media"), F.stddev_samp(value).alias("_desvio"))
    z = F.try_divide(F.col(value) - F.col("_media"), F.col("_desvio"))
    j = f.join(stats, key, "inner").withColumn("_z", z).filter(F.abs(F.col("_z")) > threshold)
    return j.orderBy(F.abs(F.col("_z")).desc(), *[F.col(c).asc() for c in ties]).limit(top).select(*extra, F.round("_z", 1).alias("z_score"))


def profile(series: DataFrame, keys: Sequence[str] = ("indicador", "unidade"), date: str = "data",
            value: str = "valor") -> DataFrame:
    """first/last date, number of days, min and max value per key."""
    return series.groupBy(*keys).agg(
        F.min(date).alias("primeira_data"), F.max(date).alias("ultima_data"),
        F.count("*").alias("dias"), F.min(value).alias("minimo"), F.max(value).alias("maximo"))
