"""Medallion plans: Bronze frames -> Silver (clean + ledger) -> Gold
(time and indicator dimensions, daily change fact, wide window fact).

Each function returns lazy DataFrames; nothing is collected on the driver.
The wide fact is one row per reference-series day, so its size is bounded by
the calendar (~252 rows a year) whatever the input volume; its windows still
run through ``WindowPlan`` so that no step puts a whole series behind an
``Exchange SinglePartition`` (block path), and the keyed variants partition by
key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.functions import metrics as M
from tempora.operators.calendar import date_spine, dim_time as _dim_time
from tempora.operators.clean import normalise, normalise_long, waterfall
from tempora.operators.windows import join_null_safe, WindowPlan
from tempora.plans.series_catalogue import (
    BAND_LABELS, HORIZONS, INDICATOR_COLUMNS, INDICATORS, LEDGER_COLUMNS, REFERENCE_CODE,
    REGIME_LABELS, SERIES, WIDE_CODES,
)
from tempora.sources.ingest import LINEAGE_TS

STUDY_CUTOFF = "2017-01-01"     # study period start (reference data)
FIXTURE_CUTOFF = "1996-01-01"   # period start used with the local test tables
FIXED_RUN_TS = "2026-09-27 00:00:00"

DEFAULT_BLOCK_ROWS = 10_000     # ~40 years of business days per block


def silver(frames, cutoff=STUDY_CUTOFF, run_ts=None,
           specs=SERIES, materialise=None) -> tuple[DataFrame, DataFrame]:
    """``(serie_diaria, controle_qualidade)`` from raw text.

    ``frames``: either a dict of per-source raw frames (the sources' own
    column names) or one stacked ``(tabela, data_txt, valor_txt)`` frame.
    ``serie_diaria``: ``data, indicador, valor DECIMAL(18,6), fonte, unidade,
    _data_ingestao``; one row per (indicador, data). ``controle_qualidade``:
    one row per indicator with the waterfall counters and ``data_execucao``.
    """
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    if isinstance(frames, dict):
        long = normalise(frames, specs)
    else:
        long = normalise_long(frames, specs)
    if LINEAGE_TS not in long.columns:
        long = long.withColumn(LINEAGE_TS, ts)
    clean, ledger = waterfall(long, ["indicador"], "data", "valor", cutoff, materialise=materialise)
    clean = clean.select("data", "indicador", "valor", "fonte", "unidade", LINEAGE_TS)
    ledger = ledger.select(*LEDGER_COLUMNS).withColumn("data_execucao", ts)
    return clean, ledger


def dim_time(silver_df: DataFrame, reference: str = REFERENCE_CODE) -> DataFrame:
    """C4: one row per calendar day between the first and last Silver date,
    flagged when the reference series was published that day."""
    spine = date_spine(silver_df, "data")
    flags = silver_df.filter(F.col("indicador") == reference).select("data")
    return _dim_time(spine, flags, "data")


def dim_indicator(spark: SparkSession) -> DataFrame:
    """The static indicator dimension."""
    schema = T.StructType([T.StructField(c, T.StringType(), False) for c in INDICATOR_COLUMNS])
    return spark.createDataFrame(INDICATORS, schema)


def daily_fact(silver_df: DataFrame, keys: Sequence[str] = ("indicador",)) -> DataFrame:
    """Value and change vs the previous *observation* of the same key.

    Keyed window: after de-duplication a key holds at most one row per
    calendar day, so each window partition is bounded by the calendar."""
    w = Window.partitionBy(*keys).orderBy("data")
    v = F.col("valor").cast("double")
    prev = F.lag(v).over(w)
    return silver_df.select(
        "data", *keys, v.alias("valor"),
        (v - prev).alias("variacao_abs"),
        M.pct_change(v, prev).alias("variacao_pct"))


def pivot_wide(silver_df: DataFrame, codes: dict[str, str] = WIDE_CODES,
               keys: Sequence[str] = ()) -> DataFrame:
    """Long -> wide with a fixed value list (no distinct job), one
    row per date; values as DOUBLE."""
    p = (silver_df.groupBy(*keys, "data").pivot("indicador", list(codes))
         .agg(F.first("valor")))
    return p.select(*keys, "data", *[F.col(k).cast("double").alias(v) for k, v in codes.items()])


def align_last_known(silver_df: DataFrame, codes: dict[str, str] = WIDE_CODES,
                     reference: str = REFERENCE_CODE, keys: Sequence[str] = (),
                     with_row_numbers: bool = False) -> DataFrame:
    """Reference-calendar rows with every other series at its last
    value published on or before that day (never a later one).

    Forward fill runs over the pivoted dates themselves: a densified calendar
    day with no observation cannot change any last-known value, so the
    result equals fill-over-a-daily-spine-then-keep-reference-days, without
    building or joining the spine. Buckets are months, so a (key, month)
    group holds at most 31 rows: one aggregate gives each bucket its last
    non-NULL values and its count of reference days, one window over that
    summary carries values and row offsets across buckets, and one window
    inside each bucket finishes the fill -- and, with ``with_row_numbers``,
    the dense row number ``_rn`` of each reference day per key that the
    ordered-block windows need (saving a second pass)."""
    keys = list(keys)
    wide = pivot_wide(silver_df, codes, keys)
    ref_col = codes[reference]
    others = [v for k, v in codes.items() if k != reference]
    b = wide.withColumn("_bkt", F.trunc("data", "month"))
    is_ref = F.col(ref_col).isNotNull()
    per = b.groupBy(*keys, "_bkt").agg(
        F.count_if(is_ref).alias("_cnt"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("data"))).alias(f"_last_{c}") for c in others])
    w_sum = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_bkt") \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(
        *keys, "_bkt", F.coalesce(F.sum("_cnt").over(w_sum), F.lit(0)).alias("_off"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(w_sum).alias(f"_carry_{c}") for c in others])
    w_in = Window.partitionBy(*keys, "_bkt").orderBy("data").rowsBetween(Window.unboundedPreceding, 0)
    filled = join_null_safe(b, carry, [*keys, "_bkt"]).withColumns({
        **{c: F.coalesce(F.last(c, ignorenulls=True).over(w_in), F.col(f"_carry_{c}")) for c in others},
        "_rn": F.col("_off") + F.sum(F.when(is_ref, 1).otherwise(0)).over(w_in) - 1,
    })
    out_cols = [*keys, "data", *codes.values()] + (["_rn"] if with_row_numbers else [])
    return filled.filter(is_ref).select(*out_cols)


def _regime_cuts(df: DataFrame, col: str, keys: Sequence[str], exact: bool, accuracy: int) -> DataFrame:
    q = M.quantile(col, [1 / 3, 2 / 3], exact=exact, accuracy=accuracy)
    return df.groupBy(*keys).agg(q.alias("_cuts"))


def wide_fact(silver_df: DataFrame, block_rows: int | None = DEFAULT_BLOCK_ROWS,
              exact_regime: bool = False, regime_accuracy: int = 10000,
              horizons: Sequence[tuple[int, int]] = HORIZONS, keys: Sequence[str] = (),
              materialise=None, vol_min_periods: int | None = None) -> DataFrame:
    """``fato_janela_cambial`` (36 columns without keys).

    Windows are ROWS frames over reference days: lags 1 and 5, rolling 21/63/
    252 rows, leads and forward maxima up to the longest horizon. With
    ``block_rows`` they run in ordered blocks with a halo of 251 rows before
    and the longest horizon after (see ``operators.windows``).

    Partial frames at the start of a series yield values, as in the study
    (volatility from the second return on); ``vol_min_periods`` instead keeps
    the volatility NULL until that many returns are in its 21-row frame.

    The regime cut points are quantiles over the whole windowed table, which
    is therefore read twice; pass ``materialise`` (e.g. ``cut_lineage``) to
    write it once instead of computing it twice."""
    keys = list(keys)
    blocked = block_rows is not None
    base = align_last_known(silver_df, keys=keys, with_row_numbers=blocked)
    max_h = max(du for du, _ in horizons)
    plan = WindowPlan(base, keys, ["data"], block_rows, pre=251, post=max_h, numbered=blocked)
    w, frame = plan.base, plan.frame
    df = plan.df.withColumn("_ptax_dec", F.col("ptax").cast("decimal(18,6)"))
    df = df.withColumns({
        "ret_ptax": M.log_return("ptax", F.lag("ptax").over(w)),
        "ret_dolar_amplo": M.log_return("dolar_amplo", F.lag("dolar_amplo").over(w)),
        "ret_vix": M.log_return("vix", F.lag("vix").over(w)),
        "ret_brent": M.log_return("brent", F.lag("brent").over(w)),
        "var_ptax_5d_pct": M.pct_change("ptax", F.lag("ptax", 5).over(w)),
    })
    df = df.withColumns({
        "vol_21d_anual_pct": M.annualised_vol(F.stddev_samp("ret_ptax").over(frame(-20, 0)))
        if vol_min_periods is None else
        F.when(F.count("ret_ptax").over(frame(-20, 0)) >= vol_min_periods,
               M.annualised_vol(F.stddev_samp("ret_ptax").over(frame(-20, 0)))),
        # mean of the 6-decimal levels as DECIMAL: no dependence on the order of a double sum
        "mm_63d": F.avg("_ptax_dec").over(frame(-62, 0)).cast("double"),
        "min_252d": F.min("ptax").over(frame(-251, 0)),
        "max_252d": F.max("ptax").over(frame(-251, 0)),
    })
    df = df.withColumns({
        "desvio_mm63_pct": M.pct_change("ptax", "mm_63d"),
        "posicao_faixa_252d": M.range_position("ptax", "min_252d", "max_252d"),
        "diferencial_juros_pp": M.spread("cdi", "fed_funds"),
    })
    fwd_cols = {}
    for du, dc in horizons:
        fut = F.lead("ptax", du).over(w)
        fwd_cols[f"ptax_em_{dc}d"] = fut
        fwd_cols[f"_max_{dc}d"] = F.max("ptax").over(frame(1, du))
    df = df.withColumns(fwd_cols)
    df = plan.finish(df)
    if materialise is not None:
        df = materialise(df)

    cuts = _regime_cuts(df, "vol_21d_anual_pct", keys, exact_regime, regime_accuracy)
    if keys:
        df = join_null_safe(df, cuts, keys)          # one row per key
    else:
        # uncorrelated scalar subquery: computed once, used as a value (no join)
        df = df.withColumn("_cuts", cuts.scalar())
    df = df.withColumns({
        "regime_vol": M.cut_buckets("vol_21d_anual_pct", [F.col("_cuts")[0], F.col("_cuts")[1]],
                                    REGIME_LABELS),
        "faixa_252d": M.band("posicao_faixa_252d", 0.25, 0.75, BAND_LABELS),
    })
    out_cols = {}
    for du, dc in horizons:
        fut = F.col(f"ptax_em_{dc}d")
        out_cols[f"var_futura_{dc}d_pct"] = M.pct_change(fut, "ptax")
        out_cols[f"maior_alta_{dc}d_pct"] = M.gated(fut.isNotNull(),
                                                    M.pct_change(f"_max_{dc}d", "ptax"))
        out_cols[f"fwd_teorico_{dc}d"] = M.parity_forward("ptax", "cdi", "fed_funds", du, dc)
    df = df.withColumns(out_cols)
    df = df.withColumns({f"dif_fwd_vs_spot_{dc}d_pct": M.pct_change(f"fwd_teorico_{dc}d", f"ptax_em_{dc}d")
                         for _, dc in horizons})
    return df.select(*keys, *wide_columns(horizons))


def wide_columns(horizons: Sequence[tuple[int, int]] = HORIZONS) -> list[str]:
    cols = ["data", *WIDE_CODES.values(),
            "ret_ptax", "ret_dolar_amplo", "ret_vix", "ret_brent", "var_ptax_5d_pct",
            "vol_21d_anual_pct", "mm_63d", "desvio_mm63_pct", "min_252d", "max_252d",
            "posicao_faixa_252d", "diferencial_juros_pp", "regime_vol", "faixa_252d"]
    for _, dc in horizons:
        cols += [f"ptax_em_{dc}d", f"var_futura_{dc}d_pct", f"maior_alta_{dc}d_pct",
                 f"fwd_teorico_{dc}d", f"dif_fwd_vs_spot_{dc}d_pct"]
    return cols
