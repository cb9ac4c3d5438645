"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the query semantics, not generated from the Spark plans. The
tables ``orders``, ``lineitem``, ``events`` ... are views over the same
parquet files. Notes on engine differences handled here:

* ``ln`` of a non-positive number: Spark NULL, DuckDB -inf/NaN -> CASE guard.
* ``x / 0``: Spark (ANSI) error or NULL via try_divide, DuckDB inf -> NULLIF.
* ``dayofweek``: Spark Sunday = 1, DuckDB Sunday = 0 -> +1.
* ``concat`` with NULL: Spark NULL, DuckDB skips -> ``||``.
* ``COUNT(DISTINCT a, b)``: rows with a NULL part are not counted in Spark.
* ``corr`` of constant input: Spark NULL via the guarded form, DuckDB NaN.
* ``percentile_approx`` (Spark, exact below 10k rows) -> ``quantile_disc``.
"""

from __future__ import annotations

import math

# fixed values: columns, codes, cutoff and horizons of the study's tables
WIDE_COLS = ["ptax", "cdi", "fed_funds", "dolar_amplo", "vix", "brent"]
CODES = {"PTAX_VENDA": "ptax", "CDI": "cdi", "FED_FUNDS": "fed_funds",
         "DOLAR_AMPLO": "dolar_amplo", "VIX": "vix", "BRENT": "brent"}
CUTOFF = "1996-01-01"
HORIZONS = [(21, 30), (42, 60), (63, 90)]

SERIES_SQL = """
  ('bcb_ptax', 'PTAX_VENDA', 'Banco Central - SGS 1', 'BRL por USD', 'dmy'),
  ('bcb_cdi', 'CDI', 'Banco Central - SGS 4389', '% ao ano', 'dmy'),
  ('fred_fed_funds', 'FED_FUNDS', 'FRED - DFF', '% ao ano', 'ymd'),
  ('fred_dolar_amplo', 'DOLAR_AMPLO', 'FRED - DTWEXBGS', 'índice (jan/2006 = 100)', 'ymd'),
  ('fred_vix', 'VIX', 'FRED - VIXCLS', 'pontos', 'ymd'),
  ('fred_brent', 'BRENT', 'FRED - DCOILBRENTEU', 'USD por barril', 'ymd')
"""

#: fixed values: plausible range per series
BOUNDS_SQL = """('PTAX_VENDA', 2.0, 8.0), ('CDI', 0.0, 20.0), ('FED_FUNDS', 0.0, 10.0),
               ('DOLAR_AMPLO', 80.0, 160.0), ('VIX', 5.0, 100.0), ('BRENT', 5.0, 200.0)"""


def _r(expr: str, n: int) -> str:
    return f"ROUND({expr}, {n})"


def ratio(a: str, b: str) -> str:
    return f"(({a}) / NULLIF(({b}), 0))"


def pct(a: str, b: str) -> str:
    return f"(({ratio(a, b)} - 1) * 100)"


def logret(a: str, b: str) -> str:
    r = ratio(a, b)
    return f"(CASE WHEN {r} > 0 THEN ln({r}) END)"


# ---------------------------------------------------------------- bronze / silver
def bronze_ctes() -> str:
    """Six raw-layout series as text in one long CTE ``bronze``
    (tabela, indicador, fonte, unidade, fmt, data_txt, valor_txt)."""
    return f"""
o_day AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'PTAX_VENDA' WHEN '2-HIGH' THEN 'DOLAR_AMPLO'
                              ELSE 'VIX' END AS indicador,
         CAST(o_orderdate AS DATE) AS d,
         SUM(CAST(ROUND(o_totalprice * 100) AS HUGEINT)) AS c, COUNT(o_totalprice) AS n
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  GROUP BY 1, 2 HAVING COUNT(o_totalprice) > 0),
f_day AS (
  SELECT CASE l_returnflag WHEN 'R' THEN 'CDI' ELSE 'FED_FUNDS' END AS indicador,
         CAST(l_shipdate AS DATE) AS d,
         SUM(CAST(ROUND(CASE WHEN l_returnflag = 'R' THEN l_discount ELSE l_tax END * 100) AS HUGEINT)) AS c,
         COUNT(CASE WHEN l_returnflag = 'R' THEN l_discount ELSE l_tax END) AS n
  FROM lineitem WHERE l_returnflag IN ('R', 'A')
  GROUP BY 1, 2 HAVING n > 0),
u_row AS (
  SELECT CAST(l_shipdate AS DATE) AS d,
         (2 * CAST(ROUND(l_extendedprice * 100) AS HUGEINT) * 100000000
          + CAST(ROUND(l_quantity * 100) AS HUGEINT))
         // NULLIF(2 * CAST(ROUND(l_quantity * 100) AS HUGEINT), 0) AS u
  FROM lineitem WHERE l_linestatus = 'O'),
s_day AS (
  SELECT indicador, d, (2 * c * 10000 + n) // (2 * n) AS m FROM o_day
  UNION ALL SELECT indicador, d, (2 * c * 1000000 + n) // (2 * n) FROM f_day
  UNION ALL SELECT 'BRENT', d, (2 * SUM(u) + 100 * COUNT(u)) // (200 * COUNT(u)) FROM u_row GROUP BY d HAVING COUNT(u) > 0),
s_txt AS (
  SELECT indicador, d, CASE WHEN m < 0 THEN '-' ELSE '' END || printf('%d.%06d', abs(m) // 1000000, abs(m) % 1000000) AS valor_txt FROM s_day),
spec(tabela, indicador, fonte, unidade, fmt) AS (VALUES {SERIES_SQL}),
fred_span AS (
  SELECT s.indicador, UNNEST(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY))::DATE AS d
  FROM s_txt s JOIN spec p ON p.indicador = s.indicador WHERE p.fmt = 'ymd' GROUP BY s.indicador),
good AS (
  SELECT p.tabela, p.indicador, p.fonte, p.unidade, p.fmt,
         strftime(s.d, '%d/%m/%Y') AS data_txt, s.valor_txt, date_diff('day', DATE '1970-01-01', s.d) AS dia
  FROM s_txt s JOIN spec p ON p.indicador = s.indicador WHERE p.fmt = 'dmy'
  UNION ALL
  SELECT p.tabela, p.indicador, p.fonte, p.unidade, p.fmt,
         strftime(f.d, '%Y-%m-%d'), s.valor_txt, date_diff('day', DATE '1970-01-01', f.d)
  FROM fred_span f JOIN spec p ON p.indicador = f.indicador
  LEFT JOIN s_txt s ON s.indicador = f.indicador AND s.d = f.d),
bronze AS (
  SELECT * EXCLUDE (dia) FROM good
  UNION ALL SELECT * EXCLUDE (dia) FROM good WHERE dia % 17 = 0
  UNION ALL SELECT * EXCLUDE (dia) REPLACE ('n/d' AS data_txt) FROM good WHERE dia % 101 = 0
  UNION ALL SELECT * EXCLUDE (dia) REPLACE ('.' AS valor_txt) FROM good WHERE dia % 53 = 0
  UNION ALL SELECT * EXCLUDE (dia) REPLACE ('-' || valor_txt AS valor_txt) FROM good WHERE dia % 71 = 0)"""


def silver_ctes(cutoff: str = CUTOFF) -> str:
    return bronze_ctes() + f""",
typed AS (
  SELECT indicador, fonte, unidade,
         CAST(CASE WHEN fmt = 'dmy' THEN try_strptime(data_txt, '%d/%m/%Y')
                   ELSE try_strptime(data_txt, '%Y-%m-%d') END AS DATE) AS data,
         TRY_CAST(trim(valor_txt) AS DECIMAL(18,6)) AS valor
  FROM bronze),
labelled AS (
  SELECT *, CASE WHEN data IS NULL THEN 'data_invalida'
                 WHEN data < DATE '{cutoff}' THEN 'fora_periodo'
                 WHEN valor IS NULL THEN 'sem_valor'
                 WHEN valor <= 0 THEN 'valor_invalido' END AS regra
  FROM typed),
dedup AS (
  SELECT indicador, data, MAX(valor) AS valor, ANY_VALUE(fonte) AS fonte,
         ANY_VALUE(unidade) AS unidade, COUNT(*) AS n
  FROM labelled WHERE regra IS NULL GROUP BY indicador, data),
silver AS (SELECT data, indicador, valor, fonte, unidade FROM dedup),
ledger AS (
  SELECT l.indicador, COUNT(*) AS linhas_bronze,
         COUNT(*) FILTER (WHERE regra = 'data_invalida') AS data_invalida,
         COUNT(*) FILTER (WHERE regra = 'fora_periodo') AS fora_periodo,
         COUNT(*) FILTER (WHERE regra = 'sem_valor') AS sem_valor,
         COUNT(*) FILTER (WHERE regra = 'valor_invalido') AS valor_invalido,
         COALESCE(MAX(d.dup), 0) AS duplicadas, COALESCE(MAX(d.nsil), 0) AS linhas_silver
  FROM labelled l
  LEFT JOIN (SELECT indicador, CAST(SUM(n - 1) AS BIGINT) AS dup, COUNT(*) AS nsil
             FROM dedup GROUP BY indicador) d ON d.indicador = l.indicador
  GROUP BY l.indicador)"""


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


# ---------------------------------------------------------------- gold
def daily_fact_cte() -> str:
    return """,
fato_ind AS (
  SELECT data, indicador, CAST(valor AS DOUBLE) AS valor,
         CAST(valor AS DOUBLE) - LAG(CAST(valor AS DOUBLE)) OVER w AS variacao_abs,
         (CAST(valor AS DOUBLE) / NULLIF(LAG(CAST(valor AS DOUBLE)) OVER w, 0) - 1) * 100 AS variacao_pct
  FROM silver WINDOW w AS (PARTITION BY indicador ORDER BY data))"""


def wide_ctes(key: str = "") -> str:
    """The wide fact of the CTE ``silver``; with ``key``, of each key by itself."""
    K, P = (f"{key}, ", f"PARTITION BY {key} ") if key else ("", "")
    mine = f"WHERE w2.{key} IS NOT DISTINCT FROM cuts.{key}" if key else ""
    piv = ",\n         ".join(
        f"MAX(CASE WHEN indicador = '{k}' THEN CAST(valor AS DOUBLE) END) AS {v}" for k, v in CODES.items())
    fill = ",\n         ".join(
        f"LAST_VALUE({v} IGNORE NULLS) OVER ({P}ORDER BY data ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {v}"
        for v in WIDE_COLS[1:])
    s252 = math.sqrt(252.0)
    fwd = []
    for du, dc in HORIZONS:
        fwd.append(f"LEAD(ptax, {du}) OVER w AS ptax_em_{dc}d")
        fwd.append(f"MAX(ptax) OVER ({P}ORDER BY data ROWS BETWEEN 1 FOLLOWING AND {du} FOLLOWING) AS mx_{dc}d")
    fwd_sql = ",\n         ".join(fwd)
    outs = []
    for du, dc in HORIZONS:
        outs.append(f"ptax_em_{dc}d")
        outs.append(f"{pct(f'ptax_em_{dc}d', 'ptax')} AS var_futura_{dc}d_pct")
        outs.append(f"CASE WHEN ptax_em_{dc}d IS NOT NULL THEN {pct(f'mx_{dc}d', 'ptax')} END AS maior_alta_{dc}d_pct")
        fwd_expr = f"(ptax * pow(1 + cdi / 100, {du / 252!r}) / (1 + fed_funds / 100 * {dc} / 360))"
        outs.append(f"{fwd_expr} AS fwd_teorico_{dc}d")
        outs.append(f"{pct(fwd_expr, f'ptax_em_{dc}d')} AS dif_fwd_vs_spot_{dc}d_pct")
    outs_sql = ",\n         ".join(outs)
    return f""",
piv AS (
  SELECT {K}data,
         {piv}
  FROM silver GROUP BY {K}data),
filled AS (
  SELECT {K}data, ptax,
         {fill}
  FROM piv),
ref AS (SELECT * FROM filled WHERE ptax IS NOT NULL),
w1 AS (
  SELECT *,
         {logret('ptax', 'LAG(ptax) OVER w')} AS ret_ptax,
         {logret('dolar_amplo', 'LAG(dolar_amplo) OVER w')} AS ret_dolar_amplo,
         {logret('vix', 'LAG(vix) OVER w')} AS ret_vix,
         {logret('brent', 'LAG(brent) OVER w')} AS ret_brent,
         {pct('ptax', 'LAG(ptax, 5) OVER w')} AS var_ptax_5d_pct,
         SUM(CAST(ROUND(ptax * 1000000) AS HUGEINT)) OVER f63 AS soma_63d, COUNT(ptax) OVER f63 AS n_63d,
         CAST(soma_63d AS DOUBLE) / n_63d / 1000000.0 AS mm_63d,
         MIN(ptax) OVER ({P}ORDER BY data ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS min_252d,
         MAX(ptax) OVER ({P}ORDER BY data ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS max_252d,
         cdi - fed_funds AS diferencial_juros_pp,
         {fwd_sql}
  FROM ref WINDOW w AS ({P}ORDER BY data),
              f63 AS ({P}ORDER BY data ROWS BETWEEN 62 PRECEDING AND CURRENT ROW)),
w2 AS (
  SELECT *,
         STDDEV_SAMP(ret_ptax) OVER ({P}ORDER BY data ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)
           * {s252!r} * 100 AS vol_21d_anual_pct
  FROM w1),
cuts AS (
  SELECT {K}quantile_disc(vol_21d_anual_pct, 1/3) AS q1, quantile_disc(vol_21d_anual_pct, 2/3) AS q2 FROM w2 {f'GROUP BY {key}' if key else ''}),
wide AS (
  SELECT {"w2." + K if key else ""}data, ptax, cdi, fed_funds, dolar_amplo, vix, brent,
         ret_ptax, ret_dolar_amplo, ret_vix, ret_brent, var_ptax_5d_pct, vol_21d_anual_pct,
         mm_63d, CAST((2 * soma_63d + n_63d) // (2 * n_63d) AS DOUBLE) / 1000000.0 AS mm_63d_6, {pct('ptax', 'mm_63d')} AS desvio_mm63_pct, min_252d, max_252d,
         (ptax - min_252d) / NULLIF(max_252d - min_252d, 0) AS posicao_faixa_252d,
         diferencial_juros_pp,
         CASE WHEN vol_21d_anual_pct IS NULL THEN NULL
              WHEN vol_21d_anual_pct <= q1 THEN '1-Baixa'
              WHEN vol_21d_anual_pct <= q2 THEN '2-Média' ELSE '3-Alta' END AS regime_vol,
         CASE WHEN (ptax - min_252d) / NULLIF(max_252d - min_252d, 0) IS NULL THEN NULL
              WHEN (ptax - min_252d) / NULLIF(max_252d - min_252d, 0) <= 0.25 THEN '1-Parte baixa (≤25%)'
              WHEN (ptax - min_252d) / NULLIF(max_252d - min_252d, 0) >= 0.75 THEN '3-Parte alta (≥75%)'
              ELSE '2-Intermediária' END AS faixa_252d,
         {outs_sql}
  FROM w2, cuts {mine})"""


def gold_ctes() -> str:
    return silver_ctes() + daily_fact_cte() + wide_ctes()


# ---------------------------------------------------------------- per query
def R6(col: str, expr: str | None = None) -> str:
    if (col, expr) == ("mm_63d", None):     # half-up on the exact sum: a double is rounded otherwise at ...5
        return "mm_63d_6 AS mm_63d"
    return f"ROUND({expr or col}, 6) AS {col}"


def wide_select(cols: list[str], string_cols=("regime_vol", "faixa_252d")) -> str:
    sel = ["data"] + [c if c in string_cols else R6(c) for c in cols]
    return with_(gold_ctes(), "SELECT " + ", ".join(sel) + " FROM wide")


WIDE_ALL = ["ptax", "cdi", "fed_funds", "dolar_amplo", "vix", "brent",
            "ret_ptax", "ret_dolar_amplo", "ret_vix", "ret_brent", "var_ptax_5d_pct",
            "vol_21d_anual_pct", "mm_63d", "desvio_mm63_pct", "min_252d", "max_252d",
            "posicao_faixa_252d", "diferencial_juros_pp", "regime_vol", "faixa_252d"]
for _du, _dc in HORIZONS:
    WIDE_ALL += [f"ptax_em_{_dc}d", f"var_futura_{_dc}d_pct", f"maior_alta_{_dc}d_pct",
                 f"fwd_teorico_{_dc}d", f"dif_fwd_vs_spot_{_dc}d_pct"]


def round6(x: str, n: int) -> str:
    """Half-up rounding of a value carrying six decimals, on the decimal value."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,6)), {n}) AS DOUBLE)"


def safe_corr(a: str, b: str) -> str:
    a2 = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
    b2 = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
    return f"(covar_samp({a2}, {b2}) / NULLIF(stddev_samp({a2}) * stddev_samp({b2}), 0))"


def pct_true(cond: str) -> str:
    return f"100 * AVG(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def no_negative_zero(sql: str) -> str:
    """Wrap every ``ROUND(...)`` as ``(ROUND(...) + 0.0)``: DuckDB keeps the
    sign of a value rounded to zero (-0.0) where Spark's decimal rounding gives
    0.0; adding +0.0 turns -0.0 into 0.0 and changes nothing else."""
    out, i = [], 0
    key = "ROUND("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = no_negative_zero(sql[j + len(key):k])
        out.append(sql[i:j] + "(ROUND(" + inner + ") + 0.0)")
        i = k + 1


def all_sql(recent_since: str) -> dict[str, str]:
    return {k: no_negative_zero(v) for k, v in _all_sql(recent_since).items()}


def _all_sql(recent_since: str) -> dict[str, str]:
    q: dict[str, str] = {}
    G = gold_ctes()
    S = silver_ctes()
    q["bronze_roundtrip"] = with_(bronze_ctes(), "SELECT tabela, data_txt, valor_txt FROM bronze")
    q["silver_long"] = with_(S, "SELECT data, indicador, valor, fonte, unidade FROM silver")
    q["silver_ledger"] = with_(S, """SELECT indicador, linhas_bronze, data_invalida, fora_periodo, sem_valor,
        valor_invalido, duplicadas, linhas_silver FROM ledger""")
    q["silver_profile"] = with_(S, """SELECT indicador, unidade, MIN(data) AS primeira_data, MAX(data) AS ultima_data,
        COUNT(*) AS dias, MIN(valor) AS minimo, MAX(valor) AS maximo FROM silver GROUP BY indicador, unidade""")
    q["dim_time"] = with_(S, """,
spine AS (SELECT UNNEST(generate_series(MIN(data), MAX(data), INTERVAL 1 DAY))::DATE AS data FROM silver),
flags AS (SELECT DISTINCT data FROM silver WHERE indicador = 'PTAX_VENDA')
SELECT s.data, CAST(year(s.data) AS INTEGER) AS ano, CAST(quarter(s.data) AS INTEGER) AS trimestre,
       CAST(month(s.data) AS INTEGER) AS mes, strftime(s.data, '%Y-%m') AS ano_mes,
       CAST(weekofyear(s.data) AS INTEGER) AS semana_ano,
       (['domingo', 'segunda', 'terça', 'quarta', 'quinta', 'sexta', 'sábado'])[dayofweek(s.data) + 1] AS dia_semana,
       f.data IS NOT NULL AS eh_dia_util_ptax
FROM spine s LEFT JOIN flags f ON f.data = s.data""".replace("SELECT s.data", "SELECT s.data", 1))
    q["dim_indicator"] = with_(S, """,
dim(indicador, nome, categoria, unidade, fonte, periodicidade) AS (VALUES
  ('PTAX_VENDA', 'PTAX venda USD/BRL', 'Câmbio', 'BRL por USD', 'Banco Central - SGS 1', 'diária (dias úteis BR)'),
  ('CDI', 'CDI anualizado base 252', 'Juros Brasil', '% ao ano', 'Banco Central - SGS 4389', 'diária (dias úteis BR)'),
  ('FED_FUNDS', 'Fed Funds efetivo', 'Juros EUA', '% ao ano', 'FRED - DFF', 'diária (dias corridos)'),
  ('DOLAR_AMPLO', 'Índice amplo do dólar (Fed)', 'Força global do dólar', 'índice (jan/2006 = 100)', 'FRED - DTWEXBGS', 'diária, publicada semanalmente'),
  ('VIX', 'Índice de volatilidade VIX', 'Aversão a risco', 'pontos', 'FRED - VIXCLS', 'diária (dias úteis EUA)'),
  ('BRENT', 'Petróleo Brent spot', 'Commodity', 'USD por barril', 'FRED - DCOILBRENTEU', 'diária (dias úteis)'))
SELECT dim.*, COUNT(silver.indicador) AS linhas_silver, MIN(silver.data) AS primeira_data, MAX(silver.data) AS ultima_data
FROM dim LEFT JOIN silver ON silver.indicador = dim.indicador GROUP BY ALL""")
    q["daily_change"] = with_(S + daily_fact_cte(), f"""SELECT data, indicador, {R6('valor')},
        {R6('variacao_abs')}, {R6('variacao_pct')} FROM fato_ind""")
    q["align_last_known"] = wide_select(WIDE_COLS)
    q["log_returns"] = wide_select(["ret_ptax", "ret_dolar_amplo", "ret_vix", "ret_brent"])
    q["pct_change_5"] = wide_select(["var_ptax_5d_pct"])
    q["realised_vol"] = wide_select(["vol_21d_anual_pct"])
    q["moving_avg_dev"] = wide_select(["mm_63d", "desvio_mm63_pct"])
    q["range_position"] = wide_select(["min_252d", "max_252d", "posicao_faixa_252d"])
    q["rate_diff"] = wide_select(["diferencial_juros_pp"])
    q["vol_regime"] = wide_select(["vol_21d_anual_pct", "regime_vol"])
    q["range_band"] = wide_select(["posicao_faixa_252d", "faixa_252d"])
    q["forward_outcome"] = wide_select([c for _, dc in HORIZONS for c in (f"ptax_em_{dc}d", f"var_futura_{dc}d_pct")])
    q["worst_rise"] = wide_select([f"maior_alta_{dc}d_pct" for _, dc in HORIZONS])
    q["parity_forward"] = wide_select([f"fwd_teorico_{dc}d" for _, dc in HORIZONS])
    q["fwd_vs_realised"] = wide_select([f"dif_fwd_vs_spot_{dc}d_pct" for _, dc in HORIZONS])
    q["wide_fact"] = wide_select(WIDE_ALL)

    # quality
    disc = "c.data_invalida + c.fora_periodo + c.sem_valor + c.valor_invalido + c.duplicadas"
    q["dq_reconcile"] = with_(S + daily_fact_cte(), f"""
SELECT c.indicador, c.linhas_bronze, {disc} AS descartadas, c.linhas_silver,
       c.linhas_bronze - ({disc}) - c.linhas_silver AS diferenca_bronze_silver,
       g.linhas_gold, c.linhas_silver - g.linhas_gold AS diferenca_silver_gold
FROM ledger c JOIN (SELECT indicador, COUNT(*) AS linhas_gold FROM fato_ind GROUP BY indicador) g
  ON g.indicador = c.indicador""")
    q["dq_grain"] = with_(G, """SELECT (SELECT COUNT(*) FROM silver WHERE indicador = 'PTAX_VENDA') AS dias_ptax_silver,
       (SELECT COUNT(*) FROM wide) AS linhas_fato_janela""")
    nul = " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos, "
        f"ROUND(100.0 * COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*), 2) AS pct_nulos FROM wide"
        for c in ["data"] + WIDE_ALL)
    q["dq_nulls"] = with_(G, nul)
    dims = """,
dim_tempo AS (SELECT UNNEST(generate_series(MIN(data), MAX(data), INTERVAL 1 DAY))::DATE AS data FROM silver),
dim_ind AS (SELECT * FROM (VALUES ('PTAX_VENDA'), ('CDI'), ('FED_FUNDS'), ('DOLAR_AMPLO'), ('VIX'), ('BRENT')) t(indicador))"""
    q["dq_unique"] = with_(G + dims, """
SELECT 'silver.serie_diaria (data x indicador)' AS tabela,
       COUNT(*) - COUNT(DISTINCT (data, indicador)) FILTER (WHERE data IS NOT NULL AND indicador IS NOT NULL) AS duplicadas FROM silver
UNION ALL SELECT 'gold.fato_indicador_diario (data x indicador)',
       COUNT(*) - COUNT(DISTINCT (data, indicador)) FILTER (WHERE data IS NOT NULL AND indicador IS NOT NULL) FROM fato_ind
UNION ALL SELECT 'gold.fato_janela_cambial (data)', COUNT(*) - COUNT(DISTINCT data) FROM wide
UNION ALL SELECT 'gold.dim_tempo (data)', COUNT(*) - COUNT(DISTINCT data) FROM dim_tempo
UNION ALL SELECT 'gold.dim_indicador (indicador)', COUNT(*) - COUNT(DISTINCT indicador) FROM dim_ind""")
    q["dq_orphans"] = with_(G + dims, """
SELECT 'fato_janela_cambial -> dim_tempo' AS relacao, COUNT(*) AS orfaos
FROM wide f ANTI JOIN dim_tempo d ON f.data = d.data
UNION ALL SELECT 'fato_indicador_diario -> dim_tempo', COUNT(*) FROM fato_ind f ANTI JOIN dim_tempo d ON f.data = d.data
UNION ALL SELECT 'fato_indicador_diario -> dim_indicador', COUNT(*) FROM fato_ind f ANTI JOIN dim_ind d ON f.indicador = d.indicador""")
    q["dq_range"] = with_(S, f""",
limites AS (SELECT indicador, CAST(mn AS DOUBLE) AS minimo_esperado, CAST(mx AS DOUBLE) AS maximo_esperado
  FROM (VALUES {BOUNDS_SQL}) t(indicador, mn, mx))
SELECT l.indicador, l.minimo_esperado, l.maximo_esperado, MIN(s.valor) AS minimo_obs, MAX(s.valor) AS maximo_obs,
       CAST(SUM(CASE WHEN CAST(s.valor AS DOUBLE) NOT BETWEEN l.minimo_esperado AND l.maximo_esperado THEN 1 ELSE 0 END) AS BIGINT) AS fora_da_faixa
FROM silver s JOIN limites l ON s.indicador = l.indicador
GROUP BY l.indicador, l.minimo_esperado, l.maximo_esperado""")
    q["dq_gaps"] = with_(S, """,
g AS (SELECT indicador, data, CAST(date_diff('day', LAG(data) OVER (PARTITION BY indicador ORDER BY data), data) AS INTEGER) AS intervalo
      FROM silver)
SELECT indicador, MAX(intervalo) AS maior_intervalo_dias,
       CAST(SUM(CASE WHEN intervalo > 4 THEN 1 ELSE 0 END) AS BIGINT) AS intervalos_acima_4_dias
FROM g GROUP BY indicador""")
    q["dq_lag"] = with_(S, """
SELECT indicador, MAX(data) AS ultima_data,
       CAST(date_diff('day', MAX(data), (SELECT MAX(data) FROM silver WHERE indicador = 'PTAX_VENDA')) AS INTEGER) AS dias_atras_da_ptax
FROM silver GROUP BY indicador""")
    z = "((f.variacao_pct - e.media) / NULLIF(e.desvio, 0))"
    q["dq_outliers"] = with_(S + daily_fact_cte(), f""",
estat AS (SELECT indicador, AVG(variacao_pct) AS media, STDDEV_SAMP(variacao_pct) AS desvio
          FROM fato_ind WHERE indicador IN ('PTAX_VENDA', 'DOLAR_AMPLO', 'VIX', 'BRENT') GROUP BY indicador)
SELECT f.indicador, f.data, {round6('f.valor', 4)} AS valor, ROUND(f.variacao_pct, 2) AS variacao_pct,
       ROUND({z}, 1) AS z_score
FROM fato_ind f JOIN estat e ON f.indicador = e.indicador
WHERE ABS({z}) > 5 ORDER BY ABS({z}) DESC LIMIT 20""")
    q["dq_row_counts"] = with_(G + dims, """
SELECT 'dim_tempo' AS tabela, COUNT(*) AS linhas FROM dim_tempo
UNION ALL SELECT 'dim_indicador', COUNT(*) FROM dim_ind
UNION ALL SELECT 'fato_indicador_diario', COUNT(*) FROM fato_ind
UNION ALL SELECT 'fato_janela_cambial', COUNT(*) FROM wide""")

    # reports
    q["yearly_behaviour"] = with_(G, f"""
SELECT CAST(year(data) AS INTEGER) AS ano, COUNT(*) AS dias_uteis,
       {round6('min_by(ptax, data)', 4)} AS ptax_inicio, {round6('max_by(ptax, data)', 4)} AS ptax_fim,
       ROUND((max_by(ptax, data) / min_by(ptax, data) - 1) * 100, 2) AS var_no_ano_pct,
       {round6('MIN(ptax)', 4)} AS minima, {round6('MAX(ptax)', 4)} AS maxima,
       ROUND(AVG(vol_21d_anual_pct), 2) AS vol_media_pct,
       ROUND({pct_true("regime_vol = '3-Alta'")}, 1) AS pct_dias_vol_alta,
       ROUND(MAX(ABS(ret_ptax)) * 100, 2) AS maior_mov_diario_pct
FROM wide GROUP BY year(data)""")
    q["level_ma_vol"] = with_(G, f"""SELECT data, ptax, {round6('mm_63d', 4)} AS media_movel_63d,
       ROUND(vol_21d_anual_pct, 2) AS vol_21d_pct FROM wide""")
    q["step_distribution"] = with_(G, """
SELECT ROUND(AVG(ABS(var_ptax_5d_pct)), 2) AS variacao_semanal_media_abs_pct,
       ROUND(quantile_disc(var_ptax_5d_pct, 0.05), 2) AS p5_semanal_pct,
       ROUND(quantile_disc(var_ptax_5d_pct, 0.95), 2) AS p95_semanal_pct,
       ROUND(MIN(var_ptax_5d_pct), 2) AS pior_queda_semanal_pct,
       ROUND(MAX(var_ptax_5d_pct), 2) AS maior_alta_semanal_pct
FROM wide""")
    corr_cols = [("r_dolar_amplo", "corr_dolar_global"), ("r_vix", "corr_vix"),
                 ("r_brent", "corr_brent"), ("d_diferencial", "corr_diferencial_juros")]
    corr_sel = ", ".join(f"ROUND({safe_corr('r_ptax', a)}, 2) AS {n}" for a, n in corr_cols)
    q["rolling_corr_by_year"] = with_(G, f""",
r AS (
  SELECT data, year(data) AS ano,
         {logret('ptax', 'LAG(ptax, 5) OVER w')} AS r_ptax,
         {logret('dolar_amplo', 'LAG(dolar_amplo, 5) OVER w')} AS r_dolar_amplo,
         {logret('vix', 'LAG(vix, 5) OVER w')} AS r_vix,
         {logret('brent', 'LAG(brent, 5) OVER w')} AS r_brent,
         diferencial_juros_pp - LAG(diferencial_juros_pp, 5) OVER w AS d_diferencial
  FROM wide WINDOW w AS (ORDER BY data))
SELECT 'Todo o período' AS periodo, {corr_sel} FROM r
UNION ALL
SELECT CAST(ano AS VARCHAR), {corr_sel} FROM r GROUP BY ano""")
    q["rise_by_regime"] = with_(G, f"""
SELECT regime_vol, COUNT(*) AS dias,
       ROUND(AVG(maior_alta_30d_pct), 2) AS media_maior_alta_30d,
       ROUND(AVG(maior_alta_60d_pct), 2) AS media_maior_alta_60d,
       ROUND(AVG(maior_alta_90d_pct), 2) AS media_maior_alta_90d,
       ROUND(quantile_disc(maior_alta_90d_pct, 0.95), 2) AS p95_maior_alta_90d,
       ROUND(MAX(maior_alta_90d_pct), 2) AS pior_caso_90d,
       ROUND({pct_true('maior_alta_90d_pct > 5')}, 1) AS pct_dias_alta_acima_5pct
FROM wide WHERE regime_vol IS NOT NULL AND maior_alta_90d_pct IS NOT NULL
GROUP BY regime_vol""")
    q["outcome_by_band"] = with_(G, f"""
SELECT faixa_252d, COUNT(*) AS dias,
       ROUND(AVG(var_futura_90d_pct), 2) AS media_var_90d,
       ROUND({pct_true('var_futura_90d_pct > 0')}, 1) AS pct_dolar_mais_alto_em_90d,
       ROUND(AVG(maior_alta_90d_pct), 2) AS media_maior_alta_90d,
       ROUND(quantile_disc(maior_alta_90d_pct, 0.95), 2) AS p95_maior_alta_90d,
       ROUND({pct_true('maior_alta_90d_pct > 5')}, 1) AS pct_dias_alta_acima_5pct
FROM wide WHERE faixa_252d IS NOT NULL AND var_futura_90d_pct IS NOT NULL
GROUP BY faixa_252d""")
    cells = []
    for label, name in [("1-Baixa", "vol_baixa"), ("2-Média", "vol_media"), ("3-Alta", "vol_alta")]:
        cells.append(
            f"CAST(ROUND(AVG(CASE WHEN regime_vol = '{label}' THEN maior_alta_90d_pct END), 2) AS VARCHAR) || '%  (' || "
            f"CAST(SUM(CASE WHEN regime_vol = '{label}' THEN 1 ELSE 0 END) AS VARCHAR) || ')' AS {name}")
    q["band_regime_crosstab"] = with_(G, f"""
SELECT faixa_252d, {', '.join(cells)}
FROM wide WHERE faixa_252d IS NOT NULL AND regime_vol IS NOT NULL AND maior_alta_90d_pct IS NOT NULL
GROUP BY faixa_252d""")
    q["latest_snapshot"] = with_(G, """
SELECT data, ptax, ROUND(posicao_faixa_252d, 2) AS posicao_faixa_252d, faixa_252d,
       ROUND(vol_21d_anual_pct, 2) AS vol_21d_pct, regime_vol,
       ROUND(desvio_mm63_pct, 2) AS desvio_mm63_pct, ROUND(diferencial_juros_pp, 2) AS diferencial_juros_pp
FROM wide ORDER BY data DESC LIMIT 1""")
    q["carry_by_year"] = with_(G, f"""
SELECT CAST(year(data) AS INTEGER) AS ano,
       ROUND(AVG(diferencial_juros_pp), 2) AS diferencial_juros_medio_pp,
       ROUND(AVG({pct('fwd_teorico_90d', 'ptax')}), 2) AS custo_fwd_90d_pct,
       ROUND(AVG(var_futura_90d_pct), 2) AS var_media_ptax_90d_pct,
       ROUND(AVG(dif_fwd_vs_spot_90d_pct), 2) AS dif_media_fwd_vs_spot_pct,
       ROUND({pct_true('dif_fwd_vs_spot_90d_pct < 0')}, 1) AS pct_dias_dolar_acima_do_fwd
FROM wide WHERE ptax_em_90d IS NOT NULL GROUP BY year(data)""")
    T = 63 / 252
    sq = math.sqrt(T)
    x = f"LEAST(vol_21d_anual_pct / 100 * {sq!r} / {2 * math.sqrt(2.0)!r}, 6.0)"
    # erf as the integral of its density by Simpson's rule, not by the engine's series
    n = 2000
    erf = (f"{2.0 / math.sqrt(math.pi)!r} * xc / {3 * n}.0 * list_sum(list_transform(range(0, {n + 1}), lambda k: "
           f"CASE WHEN k = 0 OR k = {n} THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * exp(-((xc * k / {n}.0) ** 2))))")
    q["forward_vs_call"] = with_(G, f""",
base AS (SELECT * FROM wide WHERE data IS NOT NULL AND ptax IS NOT NULL AND cdi IS NOT NULL
           AND vol_21d_anual_pct IS NOT NULL AND regime_vol IS NOT NULL
           AND fwd_teorico_90d IS NOT NULL AND ptax_em_90d IS NOT NULL),
calc AS (SELECT *, {x} AS xc FROM base),
call AS (
  SELECT regime_vol,
         {pct('fwd_teorico_90d', 'ptax')} AS custo_ndf_pct,
         exp(-ln(1 + cdi / 100) * {T!r}) * fwd_teorico_90d * ({erf}) / ptax * 100 AS premio_call_pct,
         CAST(ptax_em_90d > fwd_teorico_90d AS INTEGER) AS call_acionada,
         GREATEST(ptax_em_90d - fwd_teorico_90d, 0.0) / ptax * 100 AS cobertura_call_pct
  FROM calc)
SELECT regime_vol, COUNT(*) AS dias,
       ROUND(AVG(custo_ndf_pct), 2) AS custo_medio_ndf_pct,
       ROUND(AVG(premio_call_pct), 2) AS premio_medio_call_pct,
       ROUND(100 * AVG(call_acionada), 1) AS pct_call_acionada,
       ROUND(AVG(CASE WHEN call_acionada = 1 THEN cobertura_call_pct END), 2) AS cobertura_media_quando_acionada_pct
FROM call GROUP BY regime_vol""")
    rs_cols = ["ptax", "cdi", "fed_funds", "vix", "vol_21d_anual_pct", "var_futura_90d_pct",
               "maior_alta_90d_pct", "fwd_teorico_90d"]
    q["recent_slice"] = with_(G, f"""
SELECT data, {', '.join(R6(c) for c in rs_cols)}, regime_vol, faixa_252d
FROM wide WHERE data >= DATE '{recent_since}' ORDER BY data LIMIT 10""")

    # keyed: events per user
    q["user_rolling_metrics"] = f"""
WITH b AS (SELECT user_id, ts, event_id, CAST(value AS DOUBLE) AS valor FROM events),
r1 AS (
  SELECT *, {logret('valor', 'LAG(valor) OVER w')} AS ret,
         CAST((2 * SUM(CAST(ROUND(valor * 100) AS HUGEINT)) OVER (w ROWS BETWEEN 62 PRECEDING AND CURRENT ROW) * 10000
               + COUNT(valor) OVER (w ROWS BETWEEN 62 PRECEDING AND CURRENT ROW))
              // (2 * COUNT(valor) OVER (w ROWS BETWEEN 62 PRECEDING AND CURRENT ROW)) AS DOUBLE) / 1000000.0 AS mm_63,
         MIN(valor) OVER (w ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS min_252,
         MAX(valor) OVER (w ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS max_252,
         LEAD(valor, 21) OVER w AS valor_futuro,
         MAX(valor) OVER (w ROWS BETWEEN 1 FOLLOWING AND 21 FOLLOWING) AS mx
  FROM b WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r2 AS (
  SELECT *, STDDEV_SAMP(ret) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS vol_21
  FROM r1)
SELECT user_id, ts, event_id, {R6('valor')}, {R6('ret')}, {R6('vol_21')}, {R6('mm_63')},
       {R6('desvio_mm63_pct', pct('valor', 'mm_63'))}, {R6('min_252')}, {R6('max_252')},
       {R6('posicao_faixa_252', '(valor - min_252) / NULLIF(max_252 - min_252, 0)')},
       {R6('valor_futuro')},
       {R6('maior_alta_pct', f"CASE WHEN valor_futuro IS NOT NULL THEN {pct('mx', 'valor')} END")}
FROM r2"""
    return q
