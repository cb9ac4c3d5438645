"""Configuration of the six-series study: which Bronze table feeds which
indicator, how its text is parsed, the indicator dimension, the accuracy
bounds and the labels used by the regime / band buckets.

Everything below is a FIXED VALUE list: codes, formats, source names, units,
labels and bounds must equal the study's published data model for results
and reports to line up. They are stated plainly, in their natural order.
"""

from __future__ import annotations

from typing import NamedTuple


class SeriesSpec(NamedTuple):
    table: str          # Bronze table name
    code: str           # indicador
    date_col: str       # text column holding the date
    date_fmt: str       # its format
    value_col: str      # text column holding the value
    source: str         # fonte
    unit: str           # unidade


# --- fixed values: series catalogue (Bronze table, code, date column, date
# format, value column, source, unit) ---------------------------------------
SERIES: list[SeriesSpec] = [
    SeriesSpec("bcb_ptax", "PTAX_VENDA", "data", "dd/MM/yyyy", "valor", "Banco Central - SGS 1", "BRL por USD"),
    SeriesSpec("bcb_cdi", "CDI", "data", "dd/MM/yyyy", "valor", "Banco Central - SGS 4389", "% ao ano"),
    SeriesSpec("fred_fed_funds", "FED_FUNDS", "observation_date", "yyyy-MM-dd", "DFF", "FRED - DFF", "% ao ano"),
    SeriesSpec("fred_dolar_amplo", "DOLAR_AMPLO", "observation_date", "yyyy-MM-dd", "DTWEXBGS", "FRED - DTWEXBGS", "índice (jan/2006 = 100)"),
    SeriesSpec("fred_vix", "VIX", "observation_date", "yyyy-MM-dd", "VIXCLS", "FRED - VIXCLS", "pontos"),
    SeriesSpec("fred_brent", "BRENT", "observation_date", "yyyy-MM-dd", "DCOILBRENTEU", "FRED - DCOILBRENTEU", "USD por barril"),
]

# --- fixed values: indicator dimension (indicador, nome, categoria, unidade,
# fonte, periodicidade) -------------------------------------------------------
INDICATORS: list[tuple[str, str, str, str, str, str]] = [
    ("PTAX_VENDA", "PTAX venda USD/BRL", "Câmbio", "BRL por USD", "Banco Central - SGS 1", "diária (dias úteis BR)"),
    ("CDI", "CDI anualizado base 252", "Juros Brasil", "% ao ano", "Banco Central - SGS 4389", "diária (dias úteis BR)"),
    ("FED_FUNDS", "Fed Funds efetivo", "Juros EUA", "% ao ano", "FRED - DFF", "diária (dias corridos)"),
    ("DOLAR_AMPLO", "Índice amplo do dólar (Fed)", "Força global do dólar", "índice (jan/2006 = 100)", "FRED - DTWEXBGS", "diária, publicada semanalmente"),
    ("VIX", "Índice de volatilidade VIX", "Aversão a risco", "pontos", "FRED - VIXCLS", "diária (dias úteis EUA)"),
    ("BRENT", "Petróleo Brent spot", "Commodity", "USD por barril", "FRED - DCOILBRENTEU", "diária (dias úteis)"),
]
INDICATOR_COLUMNS = ["indicador", "nome", "categoria", "unidade", "fonte", "periodicidade"]

# --- fixed values: indicator code -> wide-fact column name, reference first --
WIDE_CODES: dict[str, str] = {
    "PTAX_VENDA": "ptax",
    "CDI": "cdi",
    "FED_FUNDS": "fed_funds",
    "DOLAR_AMPLO": "dolar_amplo",
    "VIX": "vix",
    "BRENT": "brent",
}
REFERENCE_CODE = "PTAX_VENDA"

# --- fixed values: plausible range per indicator (indicador, min, max) -------
RANGE_BOUNDS: list[tuple[str, float, float]] = [
    ("PTAX_VENDA", 2.0, 8.0),
    ("CDI", 0.0, 20.0),
    ("FED_FUNDS", 0.0, 10.0),
    ("DOLAR_AMPLO", 80.0, 160.0),
    ("VIX", 5.0, 100.0),
    ("BRENT", 5.0, 200.0),
]

# --- fixed values: market indicators screened for z-score outliers ----------
OUTLIER_CODES = ["PTAX_VENDA", "DOLAR_AMPLO", "VIX", "BRENT"]

# --- fixed values: bucket labels ---------------------------------------------
REGIME_LABELS = ("1-Baixa", "2-Média", "3-Alta")
BAND_LABELS = ("1-Parte baixa (≤25%)", "2-Intermediária", "3-Parte alta (≥75%)")
WEEKDAY_NAMES = ["domingo", "segunda", "terça", "quarta", "quinta", "sexta", "sábado"]

# --- fixed values: horizons (business-day rows, calendar days) ---------------
HORIZONS: list[tuple[int, int]] = [(21, 30), (42, 60), (63, 90)]

# --- fixed values: ledger counter names, in waterfall order ------------------
LEDGER_RULES = ["data_invalida", "fora_periodo", "sem_valor", "valor_invalido"]
LEDGER_COLUMNS = ["indicador", "linhas_bronze", "data_invalida", "fora_periodo",
                  "sem_valor", "valor_invalido", "duplicadas", "linhas_silver"]
