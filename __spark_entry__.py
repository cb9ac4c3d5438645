"""

Every query reads the whole local test tables of ``sf_dir`` (the six daily
series are derived from ``orders`` and ``lineitem``; the keyed variants use
``events``) and returns a lazy DataFrame. ``oracle_sql`` holds an
independent DuckDB statement per query over the same parquet views.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_ROOT = os.path.dirname(os.path.abspath(__file__))
if _ROOT not in sys.path:   # importable when loaded by file path from another folder
    sys.path.insert(0, _ROOT)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import duck_library
import duck_oracle as O
from tempora.functions.metrics import round_exact
from tempora.operators import quality as Q
from tempora.plans import gold, keyed, landing, regional, reports, rollups, study, timelines
from tempora.plans.series_catalogue import OUTLIER_CODES, REFERENCE_CODE
from tempora.plans.study import round_doubles
from tempora.session import scratch_path
from tempora.sources import fixtures
from tempora.sources.ingest import ingest

FLAGSHIP_SF = "/root/testdata/sf0.001"
RECENT_SINCE = "2000-01-01"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: yearly behaviour of the reference series (Q1a) on sf0.001."""
    return reports.yearly_behaviour(study.wide(spark, FLAGSHIP_SF))


# ----------------------------------------------------------------- helpers
def _wide_cols(*cols: str):
    def q(spark, sf):
        return round_doubles(study.wide(spark, sf).select("data", *cols))
    return q


def _silver(spark, sf):
    return study.silver(spark, sf)[0]


def _ledger(spark, sf):
    return study.silver(spark, sf)[1]


def _gold_tables(spark, sf):
    s, ledger = study.silver(spark, sf)
    daily = gold.daily_fact(s)
    wide = study.wide(spark, sf)
    return s, ledger, daily, wide, gold.dim_time(s), gold.dim_indicator(spark)


def q_bronze_roundtrip(spark, sf):
    """Render the six raw files as JSON lines / CSV into a scratch folder,
    read them back as all-string text with lineage, stack them."""
    _, paths = study.landing(spark, sf)
    parts = []
    from tempora.plans.series_catalogue import SERIES
    for s in SERIES:
        opts = {} if s.date_fmt == "dd/MM/yyyy" else {"header": "true"}
        fmt = "json" if s.date_fmt == "dd/MM/yyyy" else "csv"
        raw = ingest(spark, paths[s.table], fmt, [s.date_col, s.value_col], run_ts=gold.FIXED_RUN_TS, **opts)
        parts.append(raw.select(F.lit(s.table).alias("tabela"), F.col(s.date_col).alias("data_txt"),
                                F.col(s.value_col).alias("valor_txt")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_manifest_check(spark, sf):
    """Render the landing files, then the manifest of the six expected
    raw tables (file count and bytes each)."""
    from tempora.plans.series_catalogue import SERIES
    from tempora.sources.ingest import manifest
    landing, _ = study.landing(spark, sf)
    return manifest(spark, landing, [s.table for s in SERIES]).drop("presente")


def q_dim_time(spark, sf):
    return gold.dim_time(_silver(spark, sf))


def q_dim_indicator(spark, sf):
    """The whole indicator dimension, each member with its Silver rows and
    their first and last day (members without rows count 0)."""
    rows = _silver(spark, sf).groupBy("indicador").agg(
        F.count("*").alias("linhas_silver"), F.min("data").alias("primeira_data"), F.max("data").alias("ultima_data"))
    return (gold.dim_indicator(spark).join(rows, "indicador", "left")
            .withColumn("linhas_silver", F.coalesce("linhas_silver", F.lit(0).cast("long"))))


def q_daily_change(spark, sf):
    return round_doubles(study.daily(spark, sf))


def q_dq_reconcile(spark, sf):
    s, ledger = study.silver(spark, sf)
    return Q.reconcile(ledger, gold.daily_fact(s))


def q_dq_grain(spark, sf):
    s = _silver(spark, sf)
    return Q.grain_counts({"dias_ptax_silver": s.filter(F.col("indicador") == REFERENCE_CODE),
                           "linhas_fato_janela": study.wide(spark, sf)})


def q_dq_nulls(spark, sf):
    return Q.null_profile(study.wide(spark, sf))


def q_dq_unique(spark, sf):
    s, _, daily, wide, dim_t, dim_i = _gold_tables(spark, sf)
    return Q.uniqueness({
        "silver.serie_diaria (data x indicador)": (s, ["data", "indicador"]),
        "gold.fato_indicador_diario (data x indicador)": (daily, ["data", "indicador"]),
        "gold.fato_janela_cambial (data)": (wide, ["data"]),
        "gold.dim_tempo (data)": (dim_t, ["data"]),
        "gold.dim_indicador (indicador)": (dim_i, ["indicador"]),
    })


def q_dq_orphans(spark, sf):
    s, _, daily, wide, dim_t, dim_i = _gold_tables(spark, sf)
    return Q.orphans({
        "fato_janela_cambial -> dim_tempo": (wide, dim_t, "data"),
        "fato_indicador_diario -> dim_tempo": (daily, dim_t, "data"),
        "fato_indicador_diario -> dim_indicador": (daily, dim_i, "indicador"),
    })


def q_dq_range(spark, sf):
    return Q.range_check(_silver(spark, sf), study.bounds(spark))


def q_dq_gaps(spark, sf):
    return Q.gaps(_silver(spark, sf))


def q_dq_lag(spark, sf):
    return Q.publication_lag(_silver(spark, sf), REFERENCE_CODE)


def q_dq_outliers(spark, sf):
    d = study.daily(spark, sf)
    return Q.zscore_outliers(
        d, "indicador", "variacao_pct", OUTLIER_CODES, 5.0, 20, ties=["indicador", "data"],
        extra=[F.col("indicador"), F.col("data"), round_exact("valor", 4).alias("valor"),
               F.round("variacao_pct", 2).alias("variacao_pct")])


def q_dq_row_counts(spark, sf):
    from tempora.sources.ingest import row_counts
    s, _, daily, wide, dim_t, dim_i = _gold_tables(spark, sf)
    return row_counts({"dim_tempo": dim_t, "dim_indicador": dim_i,
                       "fato_indicador_diario": daily, "fato_janela_cambial": wide})


def q_documented_tables(spark, sf):
    """Publish the Gold tables, document schema, tables and
    columns, and read the dictionary back from the catalog beside what the
    tables hold: (tabela, coluna, tipo, documentada, linhas, nulos)."""
    from tempora.plans import catalog, dictionary as D
    from tempora.sources.publish import publish
    s, _, daily, wide, dim_t, dim_i = _gold_tables(spark, sf)
    catalog.create_schema(spark, "gold", D.SCHEMA_COMMENTS["gold"], scratch_path(spark, "gold-schema"))
    tables = {"dim_tempo": dim_t, "dim_indicador": dim_i, "fato_indicador_diario": daily,
              "fato_janela_cambial": wide}
    parts = []
    for name, df in tables.items():
        full = f"gold.{name}"
        table = publish(spark, full, df)
        cols = dict(D.COLUMN_COMMENTS.get(name, {}))
        if name == "fato_janela_cambial":
            cols.update(catalog.horizon_comments(D.HORIZON_TEMPLATES))
        catalog.document(spark, full, D.TABLE_COMMENTS[name], cols)
        listed = catalog.columns(spark, full)
        held = Q.null_profile(table).withColumn("linhas", table.agg(F.count("*")).scalar())
        parts.append(listed.join(held, "coluna").select(
            F.lit(name).alias("tabela"), "coluna", "tipo", (F.coalesce("comentario", F.lit("")) != "").alias("documentada"), "linhas", "nulos"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_orphan_rows(spark, sf):
    """D5 where rows do lack their match: items whose order is not a finished
    one, orders whose customer has no credit."""
    orders = fixtures.read_table(spark, sf, "orders")
    done = orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("chave"))
    rich = fixtures.read_table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("chave"))
    items = fixtures.read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("chave"))
    return Q.orphans({"lineitem -> orders (F)": (items, done, "chave"),
                      "orders -> customer (saldo > 0)": (orders.select(F.col("o_custkey").alias("chave")), rich, "chave")})


def q_sql_gaps(spark, sf):
    """D7 through the SQL API: a named keyed window (W12) over the table."""
    study.published_silver(spark, sf)
    return spark.sql("""
        WITH steps AS (
          SELECT indicador, datediff(data, lag(data) OVER by_series) AS intervalo
          FROM silver.serie_diaria
          WINDOW by_series AS (PARTITION BY indicador ORDER BY data))
        SELECT indicador,
               max(intervalo) AS maior_intervalo_dias,
               count_if(intervalo > 4) AS intervalos_acima_4_dias
        FROM steps GROUP BY indicador""")


def q_sql_publication_lag(spark, sf):
    """D8 through the SQL API: an uncorrelated scalar subquery inside datediff."""
    study.published_silver(spark, sf)
    return spark.sql(f"""
        SELECT indicador, max(data) AS ultima_data,
               datediff((SELECT max(data) FROM silver.serie_diaria WHERE indicador = '{REFERENCE_CODE}'),
                        max(data)) AS dias_atras_da_ptax
        FROM silver.serie_diaria GROUP BY indicador""")


def _report(fn):
    def q(spark, sf):
        return fn(study.wide(spark, sf))
    return q


def q_recent_slice(spark, sf):
    return round_doubles(reports.recent_slice(study.wide(spark, sf), RECENT_SINCE, 10))


def q_user_rolling_metrics(spark, sf):
    ev = fixtures.read_table(spark, sf, "events")
    # every user, a NULL one included, in ordered blocks of bounded size
    return round_doubles(keyed.rolling_metrics(ev, ["user_id"], ["ts", "event_id"], "value",
                                               block_rows=100_000, value_scale=2))


def q_block_window_equiv(spark, sf):
    """Self-check at full size: the keyed metrics over every user of ``events``
    by both window strategies (keyed windows / range-numbered ordered blocks
    for every user); rows in one result and not the other are counted."""
    ev = fixtures.read_table(spark, sf, "events")
    args = (["user_id"], ["ts", "event_id"], "value")
    a = round_doubles(keyed.rolling_metrics(ev, *args, block_rows=None, value_scale=2))
    b = round_doubles(keyed.rolling_metrics(ev, *args, block_rows=512, value_scale=2))
    diff = a.exceptAll(b).unionByName(b.exceptAll(a))
    return (a.agg(F.count("*").alias("linhas_keyed"))
            .withColumn("linhas_blocos", b.agg(F.count("*")).scalar())
            .withColumn("diferentes", diff.agg(F.count("*")).scalar()))


def _corpus():
    """The corpus operators' queries and SQL, and the pipeline; empty where
    that subpackage is not installed."""
    try:
        import corpus_pipeline
        from tempora.llm import queries as corpus
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "tempora.llm", "tempora.llm.queries"):
            raise
        return {}, {}
    sql = corpus.oracle_sql()
    if corpus_pipeline.ORACLE_SQL:
        sql = {**sql, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {**corpus.queries(), "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _study_queries() | _corpus()[0]


def _study_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # phase 1: sources + cleaning
        "bronze_roundtrip": q_bronze_roundtrip,
        "manifest_check": q_manifest_check,
        "silver_long": lambda spark, sf: _silver(spark, sf).drop("_data_ingestao"),
        "silver_ledger": lambda spark, sf: _ledger(spark, sf).drop("data_execucao"),
        "silver_profile": lambda spark, sf: Q.profile(_silver(spark, sf)),
        # phase 2: dimensions + daily fact
        "dim_time": q_dim_time,
        "dim_indicator": q_dim_indicator,
        "daily_change": q_daily_change,
        # phase 3-4: alignment, windows, buckets, forward metrics
        "align_last_known": _wide_cols("ptax", "cdi", "fed_funds", "dolar_amplo", "vix", "brent"),
        "log_returns": _wide_cols("ret_ptax", "ret_dolar_amplo", "ret_vix", "ret_brent"),
        "pct_change_5": _wide_cols("var_ptax_5d_pct"),
        "realised_vol": _wide_cols("vol_21d_anual_pct"),
        "moving_avg_dev": _wide_cols("mm_63d", "desvio_mm63_pct"),
        "range_position": _wide_cols("min_252d", "max_252d", "posicao_faixa_252d"),
        "rate_diff": _wide_cols("diferencial_juros_pp"),
        "vol_regime": _wide_cols("vol_21d_anual_pct", "regime_vol"),
        "range_band": _wide_cols("posicao_faixa_252d", "faixa_252d"),
        "forward_outcome": _wide_cols(*[f"{p}_{dc}d{s}" for _, dc in O.HORIZONS
                                        for p, s in (("ptax_em", ""), ("var_futura", "_pct"))]),
        "worst_rise": _wide_cols(*[f"maior_alta_{dc}d_pct" for _, dc in O.HORIZONS]),
        "parity_forward": _wide_cols(*[f"fwd_teorico_{dc}d" for _, dc in O.HORIZONS]),
        "fwd_vs_realised": _wide_cols(*[f"dif_fwd_vs_spot_{dc}d_pct" for _, dc in O.HORIZONS]),
        "wide_fact": lambda spark, sf: round_doubles(study.wide(spark, sf)),
        # phase 5: quality
        "dq_reconcile": q_dq_reconcile,
        "dq_grain": q_dq_grain,
        "dq_nulls": q_dq_nulls,
        "dq_unique": q_dq_unique,
        "dq_orphans": q_dq_orphans,
        "orphan_rows": q_orphan_rows,
        "dq_range": q_dq_range,
        "dq_gaps": q_dq_gaps,
        "dq_lag": q_dq_lag,
        "dq_outliers": q_dq_outliers,
        "dq_row_counts": q_dq_row_counts,
        # phase 6: reports
        "yearly_behaviour": _report(reports.yearly_behaviour),
        "level_ma_vol": _report(reports.level_ma_vol),
        "step_distribution": _report(reports.step_distribution),
        "rolling_corr_by_year": _report(reports.rolling_corr_by_year),
        "rise_by_regime": _report(reports.rise_by_regime),
        "outcome_by_band": _report(reports.outcome_by_band),
        "band_regime_crosstab": _report(reports.band_regime_crosstab),
        "latest_snapshot": _report(reports.latest_snapshot),
        "carry_by_year": _report(reports.carry_by_year),
        "forward_vs_call": _report(reports.forward_vs_call),
        "recent_slice": q_recent_slice,
        # SQL API over published tables
        "sql_gaps": q_sql_gaps,
        "sql_publication_lag": q_sql_publication_lag,
        # phase 7: catalog
        "documented_tables": q_documented_tables,
        # phase 8: keyed / scale variants
        "user_rolling_metrics": q_user_rolling_metrics,
        "block_window_equiv": q_block_window_equiv,
        # as-of joins and frames by time
        **timelines.QUERIES,
        # landing files by year: arrays, quarantine, ledger of each file
        **landing.QUERIES,
        # the study by customer region
        **regional.QUERIES,
        # stored states: sketches, bitmaps, moments; SQL with parameters
        **rollups.QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    q = O.all_sql(RECENT_SINCE)
    q["sql_gaps"] = q["dq_gaps"]
    q["sql_publication_lag"] = q["dq_lag"]
    q["block_window_equiv"] = ("SELECT COUNT(*) AS linhas_keyed, COUNT(*) AS linhas_blocos, "
                               "CAST(0 AS BIGINT) AS diferentes FROM events")
    return q | duck_library.sql() | _corpus()[1]
