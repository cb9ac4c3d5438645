"""DuckDB SQL of the queries that go beyond the study's notebooks: as-of
joins, frames by time, array landing files, ledgers by file, sketches, bitmaps
and stored states. Written from the query semantics."""

from __future__ import annotations

import duck_oracle as O


def _client(col: str) -> str:
    return f"CASE WHEN {col} % 150 % 11 = 0 THEN NULL WHEN {col} % 150 % 3 = 0 THEN 0 ELSE {col} % 150 END"


ASOF_EVENTS_ORDERS = f"""
WITH e AS (SELECT event_id, {_client('user_id')} AS cliente, ts FROM events),
o AS (
  SELECT {_client('o_custkey')} AS cliente,
         TIMESTAMP '2024-01-01' + to_minutes(18 * date_diff('day', DATE '1995-01-01', o_orderdate::DATE)) AS pedido_em,
         max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
  FROM orders GROUP BY 1, 2)
SELECT e.event_id, e.cliente, e.ts,
       CASE WHEN o.pedido_em >= e.ts - INTERVAL 3 DAYS THEN o.o_orderkey END AS o_orderkey,
       CASE WHEN o.pedido_em >= e.ts - INTERVAL 3 DAYS THEN o.pedido_em END AS pedido_em,
       CASE WHEN o.pedido_em >= e.ts - INTERVAL 3 DAYS THEN o.o_totalprice END AS o_totalprice
FROM e ASOF LEFT JOIN o ON e.cliente = o.cliente AND e.ts >= o.pedido_em"""

USER_TIME_FRAMES = f"""
WITH b AS (SELECT user_id, ts, CAST(ROUND(value * 100) AS HUGEINT) AS x FROM events),
w AS (
  SELECT DISTINCT user_id, ts, COUNT(x) OVER f AS n, COALESCE(SUM(x) OVER f, 0) AS s1, COALESCE(SUM(x * x) OVER f, 0) AS s2
  FROM b WINDOW f AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW))
SELECT user_id, ts, n, ROUND(s1::DOUBLE / 100, 6) AS soma, ROUND(s1::DOUBLE / NULLIF(n, 0) / 100, 6) AS media,
       ROUND(CASE WHEN n > 1 THEN sqrt((n * s2 - s1 * s1)::DOUBLE / (n * (n - 1))) / 100 END, 6) AS desvio
FROM w"""

ALIGN_ALL_SERIES = """,
dias AS (SELECT data FROM silver WHERE indicador = 'PTAX_VENDA'),
quais AS (SELECT DISTINCT indicador FROM silver WHERE indicador <> 'PTAX_VENDA'),
pedidos AS (SELECT data, indicador FROM dias, quais)
SELECT p.data, p.indicador, s.data AS data_obs, s.valor
FROM pedidos p ASOF LEFT JOIN silver s ON p.indicador = s.indicador AND p.data >= s.data"""


#: the landing files: every row and its faults, and on every 61st day a record that cannot be read
FILES = """,
dated AS (SELECT *, year(DATE '1970-01-01' + dia::INTEGER) AS ano FROM good),
files AS (
  SELECT * FROM dated
  UNION ALL SELECT * FROM dated WHERE dia % 17 = 0
  UNION ALL SELECT * REPLACE ('n/d' AS data_txt) FROM dated WHERE dia % 101 = 0
  UNION ALL SELECT * REPLACE ('.' AS valor_txt) FROM dated WHERE dia % 53 = 0
  UNION ALL SELECT * REPLACE ('-' || valor_txt AS valor_txt) FROM dated WHERE dia % 71 = 0),
broken AS (
  SELECT tabela, indicador, ano,
         CASE fmt WHEN 'dmy' THEN printf('{"data":"%s","valor" "%s"}', data_txt, coalesce(valor_txt, ''))
                  ELSE data_txt || ',' || coalesce(valor_txt, '') || ',x' END AS registro
  FROM dated WHERE dia % 61 = 0)"""

BRONZE_JSON_ARRAYS = FILES + """
SELECT tabela, tabela || '/' || ano AS arquivo, data_txt, valor_txt, '2026-09-27 00:00:00' AS ingestao FROM files WHERE fmt = 'dmy'"""

BRONZE_QUARANTINE = FILES + """
SELECT tabela, tabela || '/' || ano AS arquivo, registro FROM broken"""

LEDGER_BY_FILE = FILES + """,
t AS (
  SELECT indicador, tabela || '/' || ano AS arquivo,
         CAST(CASE WHEN fmt = 'dmy' THEN try_strptime(data_txt, '%d/%m/%Y') ELSE try_strptime(data_txt, '%Y-%m-%d') END AS DATE) AS data,
         TRY_CAST(trim(valor_txt) AS DECIMAL(18,6)) AS valor
  FROM files),
l AS (
  SELECT *, CASE WHEN data IS NULL THEN 'data_invalida' WHEN data < DATE '1996-01-01' THEN 'fora_periodo'
                 WHEN valor IS NULL THEN 'sem_valor' WHEN valor <= 0 THEN 'valor_invalido' END AS regra
  FROM t
  UNION ALL SELECT indicador, tabela || '/' || ano, NULL, NULL, 'ilegiveis' FROM broken)
SELECT indicador, arquivo, COUNT(*) AS linhas_bronze, COUNT(*) FILTER (regra = 'ilegiveis') AS ilegiveis,
       COUNT(*) FILTER (regra = 'data_invalida') AS data_invalida, COUNT(*) FILTER (regra = 'fora_periodo') AS fora_periodo,
       COUNT(*) FILTER (regra = 'sem_valor') AS sem_valor, COUNT(*) FILTER (regra = 'valor_invalido') AS valor_invalido,
       COUNT(*) FILTER (regra IS NULL) - COUNT(DISTINCT data) FILTER (regra IS NULL) AS duplicadas,
       COUNT(DISTINCT data) FILTER (regra IS NULL) AS linhas_silver
FROM l GROUP BY indicador, arquivo"""

LANDING_MANIFEST = FILES + """,
esperado(arquivo) AS (SELECT tabela FROM spec UNION ALL VALUES ('bcb_selic'))
SELECT e.arquivo, COUNT(DISTINCT f.ano) AS arquivos, COUNT(f.ano) > 0 AS presente FROM esperado e LEFT JOIN files f ON f.tabela = e.arquivo GROUP BY e.arquivo"""


REGIME_CUTS_MERGED = """
SELECT l_returnflag, COUNT(*) AS linhas, COUNT(DISTINCT date_trunc('month', l_shipdate)) AS meses, TRUE AS corte1_ok, TRUE AS corte2_ok
FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag"""

DISTINCT_ORDERS_MERGED = """
SELECT year(l_shipdate)::INTEGER AS ano, COUNT(DISTINCT l_orderkey) AS pedidos FROM lineitem GROUP BY 1"""

UNIQUE_ITEMS = """
SELECT l_returnflag, COUNT(*) AS linhas, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS chaves,
       COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS duplicadas
FROM lineitem GROUP BY l_returnflag"""

ZSCORE_FROM_STATES = """
WITH p AS (SELECT event_id, event_type, ts::DATE AS dia, value FROM events WHERE ts::DATE BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'),
s AS (SELECT event_type, COUNT(value) AS n, AVG(value) AS m, STDDEV_SAMP(value) AS sd FROM p GROUP BY event_type)
SELECT event_id, p.event_type, dia, n AS linhas_periodo, ROUND((value - m) / NULLIF(sd, 0), 6) AS z_score
FROM p JOIN s ON p.event_type IS NOT DISTINCT FROM s.event_type WHERE ABS((value - m) / NULLIF(sd, 0)) > 1.7"""


def _range_check() -> str:
    return O.with_(O.silver_ctes(), f""",
l(indicador, minimo, maximo) AS (VALUES {O.BOUNDS_SQL})
SELECT l.indicador, CAST(l.minimo AS DOUBLE) AS minimo, CAST(l.maximo AS DOUBLE) AS maximo, COUNT(s.valor) AS dias,
       COUNT(*) FILTER (s.valor NOT BETWEEN l.minimo AND l.maximo) AS fora_da_faixa
FROM l LEFT JOIN silver s ON s.indicador = l.indicador AND s.data >= DATE '1998-01-01'
GROUP BY l.indicador, l.minimo, l.maximo""")


ORPHAN_ROWS = """
SELECT 'lineitem -> orders (F)' AS relacao, COUNT(*) AS orfaos FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
UNION ALL
SELECT 'orders -> customer (saldo > 0)', COUNT(*) FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)"""


def _documented(q: dict[str, str]) -> str:
    day, text, flag = "date", "string", "boolean"
    tables = {
        "dim_tempo": (q["dim_time"], {"data": day, "ano": "int", "trimestre": "int", "mes": "int", "ano_mes": text, "semana_ano": "int",
                                      "dia_semana": text, "eh_dia_util_ptax": flag}),
        "dim_indicador": (q["dim_indicator"], dict.fromkeys(["indicador", "nome", "categoria", "unidade", "fonte", "periodicidade"], text)),
        "fato_indicador_diario": (q["daily_change"], {"data": day, "indicador": text, **dict.fromkeys(["valor", "variacao_abs", "variacao_pct"], "double")}),
        "fato_janela_cambial": (q["wide_fact"], {"data": day, **{c: text if c in ("regime_vol", "faixa_252d") else "double" for c in O.WIDE_ALL}}),
    }
    parts = []
    for name, (body, cols) in tables.items():
        listed = ", ".join(f"{{'coluna': '{c}', 'tipo': '{t}', 'nulos': COUNT(*) - COUNT({c})}}" for c, t in cols.items())
        parts.append(f"SELECT '{name}' AS tabela, unnest(l, recursive := true), TRUE AS documentada, linhas FROM (SELECT COUNT(*) AS linhas, [{listed}] AS l FROM ({body}))")
    return "\nUNION ALL BY NAME\n".join(parts)


def regional_ctes() -> str:
    """Silver and ledger of the six series by customer region, straight from the tables."""
    return """
lugar AS (SELECT o_orderkey, r_name AS regiao FROM orders JOIN customer ON c_custkey = o_custkey
          JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
soma AS (
  SELECT regiao, CASE o_orderpriority WHEN '1-URGENT' THEN 'PTAX_VENDA' WHEN '2-HIGH' THEN 'DOLAR_AMPLO' ELSE 'VIX' END AS indicador,
         o_orderdate::DATE AS data, SUM(CAST(ROUND(o_totalprice * 100) AS HUGEINT)) * 10000 AS c, COUNT(o_totalprice) AS n
  FROM orders JOIN lugar USING (o_orderkey) WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY ALL
  UNION ALL
  SELECT regiao, CASE l_returnflag WHEN 'R' THEN 'CDI' ELSE 'FED_FUNDS' END, l_shipdate::DATE,
         SUM(CAST(ROUND(CASE WHEN l_returnflag = 'R' THEN l_discount ELSE l_tax END * 100) AS HUGEINT)) * 1000000,
         COUNT(CASE WHEN l_returnflag = 'R' THEN l_discount ELSE l_tax END)
  FROM lineitem JOIN lugar ON l_orderkey = o_orderkey WHERE l_returnflag IN ('R', 'A') GROUP BY ALL
  UNION ALL
  SELECT regiao, 'BRENT', data, SUM(u), 100 * COUNT(u) FROM (
    SELECT regiao, l_shipdate::DATE AS data, (2 * CAST(ROUND(l_extendedprice * 100) AS HUGEINT) * 100000000 + CAST(ROUND(l_quantity * 100) AS HUGEINT))
           // NULLIF(2 * CAST(ROUND(l_quantity * 100) AS HUGEINT), 0) AS u
    FROM lineitem JOIN lugar ON l_orderkey = o_orderkey WHERE l_linestatus = 'O') GROUP BY ALL),
medias AS (SELECT regiao, indicador, data, (2 * c + n) // (2 * n) AS m FROM soma WHERE n > 0),
silver AS (SELECT regiao, data, indicador, CAST(m / 1000000.0 AS DECIMAL(18,6)) AS valor FROM medias WHERE data >= DATE '1996-01-01' AND m > 0)"""


def _regional() -> dict[str, str]:
    base = regional_ctes()
    wide = base + O.wide_ctes("regiao")
    sel = [c if c in ("regime_vol", "faixa_252d") else O.R6(c) for c in O.WIDE_ALL]
    return {
        "ledger_by_region": O.with_(base, """
SELECT regiao, indicador, COUNT(*) AS linhas_bronze, 0::BIGINT AS data_invalida, COUNT(*) FILTER (data < DATE '1996-01-01') AS fora_periodo,
       0::BIGINT AS sem_valor, COUNT(*) FILTER (data >= DATE '1996-01-01' AND m <= 0) AS valor_invalido, 0::BIGINT AS duplicadas,
       COUNT(*) FILTER (data >= DATE '1996-01-01' AND m > 0) AS linhas_silver
FROM medias GROUP BY regiao, indicador"""),
        "daily_change_by_region": O.with_(base, f"""
SELECT regiao, data, indicador, {O.R6('valor', 'CAST(valor AS DOUBLE)')},
       {O.R6('variacao_abs', 'CAST(valor AS DOUBLE) - LAG(CAST(valor AS DOUBLE)) OVER w')},
       {O.R6('variacao_pct', '(CAST(valor AS DOUBLE) / NULLIF(LAG(CAST(valor AS DOUBLE)) OVER w, 0) - 1) * 100')}
FROM silver WINDOW w AS (PARTITION BY regiao, indicador ORDER BY data)"""),
        "wide_fact_by_region": O.with_(wide, f"SELECT regiao, data, {', '.join(sel)} FROM wide"),
        "regime_outcome_by_region": O.with_(wide, """
SELECT regiao, regime_vol, COUNT(*) AS dias, ROUND(AVG(maior_alta_90d_pct), 2) AS media_maior_alta_90d, ROUND(MAX(maior_alta_90d_pct), 2) AS pior_caso_90d,
       ROUND(quantile_disc(maior_alta_90d_pct, 0.95), 2) AS p95_maior_alta_90d,
       ROUND(100 * AVG(CASE WHEN maior_alta_90d_pct > 5 THEN 1.0 ELSE 0.0 END), 1) AS pct_dias_alta_acima_5pct
FROM wide WHERE regime_vol IS NOT NULL AND maior_alta_90d_pct IS NOT NULL GROUP BY regiao, regime_vol"""),
    }


def sql() -> dict[str, str]:
    return {
        "asof_events_orders": ASOF_EVENTS_ORDERS,
        "user_time_frames": USER_TIME_FRAMES,
        "bronze_json_arrays": O.with_(O.bronze_ctes(), BRONZE_JSON_ARRAYS),
        "bronze_quarantine": O.with_(O.bronze_ctes(), BRONZE_QUARANTINE),
        "ledger_by_file": O.with_(O.bronze_ctes(), LEDGER_BY_FILE),
        "landing_manifest": O.with_(O.bronze_ctes(), LANDING_MANIFEST),
        **_regional(),
        "orphan_rows": ORPHAN_ROWS,
        "documented_tables": _documented(O.all_sql("2000-01-01")),
        "regime_cuts_merged": REGIME_CUTS_MERGED,
        "distinct_orders_merged": DISTINCT_ORDERS_MERGED,
        "unique_items": UNIQUE_ITEMS,
        "zscore_from_states": ZSCORE_FROM_STATES,
        "sql_range_check": _range_check(),
        "align_all_series": O.with_(O.silver_ctes(), ALIGN_ALL_SERIES),
    }
