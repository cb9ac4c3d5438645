"""Data dictionary of the Gold layer (C20): table and column descriptions,
with the per-horizon columns generated from templates."""

from __future__ import annotations

SCHEMA_COMMENTS = {
    "bronze": "Bronze layer: raw source text as received, plus ingestion lineage.",
    "silver": "Silver layer: typed, de-duplicated daily series (one row per date and indicator).",
    "gold": "Gold layer: dimensional model (two facts sharing the time dimension).",
}

TABLE_COMMENTS = {
    "serie_diaria": "Cleaned long table. Grain: one row per day and series, after the waterfall.",
    "dim_tempo": "Time dimension. Grain: one calendar day between the first and last Silver date.",
    "dim_indicador": "Indicator dimension: name, category, unit, source and publication frequency.",
    "fato_indicador_diario": "Observed value per indicator and date with the change against the previous observation.",
    "fato_janela_cambial": "Reference-day fact: aligned series, risk metrics and 30/60/90-day outcomes.",
}

#: Series of the wide fact that are filled forward, with what they measure.
_FILLED = {"cdi": "domestic interest rate (% a year)", "fed_funds": "foreign interest rate (% a year)",
           "dolar_amplo": "broad currency index", "vix": "implied volatility index", "brent": "oil price"}
#: Series that also have a return column.
_RETURNS = {"ptax": "reference level", **{c: _FILLED[c] for c in ("dolar_amplo", "vix", "brent")}}
#: Statistics over a frame of rows of the wide fact that ends at the row: column -> (function, rows).
_FRAMES = {"vol_21d_anual_pct": ("Sample deviation of the log returns, times sqrt(252) and 100", 21),
           "mm_63d": ("Mean level", 63), "min_252d": ("Minimum level", 252), "max_252d": ("Maximum level", 252)}

_DAY = "Day the row belongs to."

COLUMN_COMMENTS = {
    "dim_tempo": {
        "data": "Day, without holes from the first to the last day of Silver.",
        **{c: f"{what} computed from data." for c, what in {
            "ano": "Calendar year", "trimestre": "Number of the quarter", "mes": "Number of the month",
            "ano_mes": "Text yyyy-MM", "semana_ano": "ISO week number", "dia_semana": "Name of the weekday"}.items()},
        "eh_dia_util_ptax": "Whether Silver has a row of the reference series for data.",
    },
    "dim_indicador": {
        "indicador": "Code of the series; key of the dimension.", "nome": "Name for reports.", "categoria": "What the series measures.",
        "unidade": "Unit of its values.", "fonte": "Publisher and the publisher's own code.", "periodicidade": "How often it is published.",
    },
    "serie_diaria": {
        "data": _DAY, "indicador": "Code of the series.", "valor": "Parsed number, six decimals, above zero.",
        "fonte": "Publisher of the raw file.", "unidade": "Unit of valor.",
    },
    "fato_indicador_diario": {
        "data": _DAY, "indicador": "Code of the series.", "valor": "Silver's number, unchanged.",
        "variacao_abs": "valor minus valor of the row before in the same series; NULL on its first row.",
        "variacao_pct": "variacao_abs in percent of the row before; NULL on the first row and after a zero.",
    },
    "fato_janela_cambial": {
        "data": _DAY + " Only days of the reference series have one.",
        "ptax": "Reference level, as published for the day.",
        **{c: f"Forward fill of the {what}: its last row on or before data." for c, what in _FILLED.items()},
        **{f"ret_{c}": f"ln of the {what} over its value one row earlier; NULL unless the ratio is positive."
           for c, what in _RETURNS.items()},
        "var_ptax_5d_pct": "ptax against its value five rows earlier, in percent.",
        **{c: f"{what} over {n} rows up to this one; shorter at the start." for c, (what, n) in _FRAMES.items()},
        "desvio_mm63_pct": "ptax against mm_63d, in percent.",
        "posicao_faixa_252d": "(ptax - min_252d) / (max_252d - min_252d); NULL in a flat frame.",
        "diferencial_juros_pp": "cdi - fed_funds.",
        "regime_vol": "Third of all rows, by vol_21d_anual_pct, that the row is in; the cuts see the whole series.",
        "faixa_252d": "posicao_faixa_252d cut at 0.25 and 0.75.",
    },
}

HORIZON_TEMPLATES = {
    "ptax_em_{dc}d": "ptax as many rows ahead as {dc} calendar days have reference days; NULL where the series ends.",
    "var_futura_{dc}d_pct": "ptax_em_{dc}d against ptax, in percent.",
    "maior_alta_{dc}d_pct": "Largest rise of later rows above ptax within the {dc}-day frame, in percent.",
    "fwd_teorico_{dc}d": "ptax carried {dc} days by cdi against fed_funds (interest parity).",
    "dif_fwd_vs_spot_{dc}d_pct": "fwd_teorico_{dc}d against ptax_em_{dc}d, in percent.",
}
