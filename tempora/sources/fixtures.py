"""Raw landing data derived from the local test tables.

The study's six raw files (two JSON arrays, four CSVs) are not available, so
the six daily series are derived from ``orders`` and ``lineitem`` and
rendered as text exactly in the layout the raw files have:

| indicator   | derived from                                              | raw layout                 |
|-------------|-----------------------------------------------------------|----------------------------|
| PTAX_VENDA  | avg(o_totalprice), o_orderpriority = '1-URGENT', by day    | JSON (data dd/MM/yyyy, valor) |
| CDI         | 100 * avg(l_discount), l_returnflag = 'R', by ship day      | JSON (data dd/MM/yyyy, valor) |
| FED_FUNDS   | 100 * avg(l_tax), l_returnflag = 'A', by ship day           | CSV (observation_date, DFF) |
| DOLAR_AMPLO | avg(o_totalprice), '2-HIGH'                                | CSV (observation_date, DTWEXBGS) |
| VIX         | avg(o_totalprice), '3-MEDIUM'                              | CSV (observation_date, VIXCLS) |
| BRENT       | avg(l_extendedprice / l_quantity), l_linestatus = 'O'       | CSV (observation_date, DCOILBRENTEU) |

CSV-like series cover every calendar day between their first and last
observation, with an empty value on days without one (as the public CSV
files mark holidays); JSON-like series list observed days only.

Values are rendered with six decimals, computed exactly in integer
micro-units (half-up rounding), so the text does not depend on the order in
which partial sums are combined. Each source table is scanned once: one
partial+final aggregate per table, grouped by (day, series selector).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.plans.series_catalogue import SERIES
from tempora.session import cut_lineage

# --- fixed values: which rows make which series ------------------------------
ORDER_SERIES = {"1-URGENT": "PTAX_VENDA", "2-HIGH": "DOLAR_AMPLO", "3-MEDIUM": "VIX"}
RETURNFLAG_SERIES = {"R": "CDI", "A": "FED_FUNDS"}
LINESTATUS_SERIES = {"O": "BRENT"}

# --- fixed values: on days divisible by the first number, a row with this date and value text is added
FAULTS = ((17, "data_txt", "valor_txt"), (101, "'n/d'", "valor_txt"), (53, "data_txt", "'.'"), (71, "data_txt", "'-' || valor_txt"))

DEC38 = "decimal(38,0)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_col(col: str, mapping: dict[str, str]):
    """CASE ``col`` WHEN key THEN value ... END (fixed identifiers only)."""
    arms = " ".join(f"WHEN `{col}` = '{k}' THEN '{v}'" for k, v in mapping.items())
    return F.expr(f"CASE {arms} END")


def _cents(col: str):
    """Whole hundredths of a value with at most two decimals (exact: the
    product is within 1e-9 of an integer; ``rint`` is plain double
    arithmetic, cheaper than decimal rounding)."""
    return F.rint(F.col(col) * 100).cast("bigint")


def _stack(df: DataFrame, parts: list[tuple[str, str, str, int, int]], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, day, series) from per-day conditional sums:
    ``parts`` = (indicador, sum column, count column, k, j) with the average
    in micro-units = half-up((sum * k) / (count * j))."""
    structs = ", ".join(
        f"named_struct('indicador', '{code}', 'c', CAST(`{c}` AS DECIMAL(38,0)), 'n', `{n}`, "
        f"'k', CAST({k} AS DECIMAL(38,0)), 'j', CAST({j} AS DECIMAL(38,0)))"
        for code, c, n, k, j in parts)
    return (df.select(*keys, "d", F.expr(f"explode(array({structs}))").alias("s"))
            .select(*keys, "s.indicador", "d", "s.c", "s.n", "s.k", "s.j")
            .filter(F.col("n") > 0)
            .select(*keys, "indicador", "d", F.expr("(2 * c * k + n * j) div (2 * n * j)").alias("m")))


def daily_series(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None, lineitem: DataFrame | None = None,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Long daily series ``(keys, indicador, d DATE, valor_txt STRING)``, one row
    per observed day per indicator (and key: ``orders`` and ``lineitem`` may be
    given with key columns).

    Each source table is scanned once: one aggregate grouped by day with a
    conditional sum and count per series (partial aggregation map-side, so
    only one row per day and task is shuffled), then unpivoted. Averages are
    exact, in integer micro-units (1e-6) with half-up rounding: sums of whole
    cents, then ``(2 * sum * k + n * j) div (2 * n * j)``.
    """
    keys = list(keys)
    orders = ((orders if orders is not None else read_table(spark, sf_dir, "orders"))
              .select(*keys, "o_orderdate", "o_orderpriority", "o_totalprice")
              .filter(F.col("o_orderpriority").isin(list(ORDER_SERIES))))
    prio = F.col("o_orderpriority")
    o_aggs, o_parts = [], []
    for i, (k, code) in enumerate(ORDER_SERIES.items()):
        o_aggs += [F.sum(F.when(prio == k, _cents("o_totalprice"))).alias(f"c{i}"),
                   F.count(F.when(prio == k, F.col("o_totalprice"))).alias(f"n{i}")]
        o_parts.append((code, f"c{i}", f"n{i}", 10_000, 1))
    o_day = _stack(orders.groupBy(*keys, F.to_date("o_orderdate").alias("d")).agg(*o_aggs), o_parts, keys)

    li = ((lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem"))
          .select(*keys, "l_shipdate", "l_returnflag", "l_linestatus", "l_discount", "l_tax",
                  "l_extendedprice", "l_quantity")
          .filter(F.col("l_returnflag").isin(list(RETURNFLAG_SERIES))
                  | F.col("l_linestatus").isin(list(LINESTATUS_SERIES))))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    # unit price in 1e-8 units, half-up: (2 * price_cents * 1e8 + qty_cents) div (2 * qty_cents),
    # in 64-bit integers; summed as two exact 64-bit parts (whole 1e-8 units / 1e9, remainder)
    # so a day with ~1e8 rows cannot overflow the sum
    unit = F.expr("(2 * CAST(rint(l_extendedprice * 100) AS BIGINT) * 100000000"
                  " + CAST(rint(l_quantity * 100) AS BIGINT))"
                  " div nullif(2 * CAST(rint(l_quantity * 100) AS BIGINT), 0)")
    measure = {"R": _cents("l_discount"), "A": _cents("l_tax")}
    l_aggs, l_parts = [], []
    for i, (k, code) in enumerate(RETURNFLAG_SERIES.items()):
        l_aggs += [F.sum(F.when(flag == k, measure[k])).alias(f"fc{i}"), F.count(F.when(flag == k, measure[k])).alias(f"fn{i}")]
        l_parts.append((code, f"fc{i}", f"fn{i}", 1_000_000, 1))
    li = li.withColumns({f"_u{i}": F.when(status == k, unit) for i, k in enumerate(LINESTATUS_SERIES)})
    for i, (k, code) in enumerate(LINESTATUS_SERIES.items()):
        l_aggs += [F.sum(F.expr(f"_u{i} div 1000000000")).alias(f"sh{i}"),
                   F.sum(F.expr(f"_u{i} % 1000000000")).alias(f"sl{i}"),
                   F.count(f"_u{i}").alias(f"sn{i}")]
        l_parts.append((code, f"sc{i}", f"sn{i}", 1, 100))
    l_agg = li.groupBy(*keys, F.to_date("l_shipdate").alias("d")).agg(*l_aggs)
    l_agg = l_agg.withColumns({f"sc{i}": F.col(f"sh{i}").cast(DEC38) * 1_000_000_000 + F.col(f"sl{i}").cast(DEC38)
                               for i in range(len(LINESTATUS_SERIES))})
    l_day = _stack(l_agg, l_parts, keys)

    return (o_day.unionByName(l_day)
            .select(*keys, "indicador", "d",
                    F.format_string("%s%d.%06d", F.expr("if(m < 0, '-', '')"), F.expr("abs(m) div 1000000"), F.expr("abs(m) % 1000000"))
                    .alias("valor_txt")))


def bronze_days(spark: SparkSession, sf_dir: str, materialise: bool = True) -> DataFrame:
    """All six raw-layout series in one long text table
    ``(tabela, data_txt, valor_txt, dia, falha)``: ``dia`` is the day's number,
    ``falha`` 0 for its own row and above 0 for faulty rows beside it.

    JSON-like tables list observed days (``dd/MM/yyyy``); CSV-like tables list
    every calendar day between their first and last observation
    (``yyyy-MM-dd``), with a NULL value (an empty CSV cell) on days without an
    observation. One spine per series, built from a one-row-per-series
    ``agg(min, max)`` exploded with ``sequence`` (bounded by the calendar)."""
    daily = daily_series(spark, sf_dir)
    if materialise:
        daily = cut_lineage(daily)   # the only pass over orders / lineitem
    table_of = {s.code: s.table for s in SERIES}
    dmy = [s.code for s in SERIES if s.date_fmt == "dd/MM/yyyy"]
    ymd = [s.code for s in SERIES if s.date_fmt != "dd/MM/yyyy"]
    tabela = _map_col("indicador", table_of)
    json_like = (daily.filter(F.col("indicador").isin(dmy))
                 .select(tabela.alias("tabela"), F.date_format("d", "dd/MM/yyyy").alias("data_txt"),
                         "valor_txt", F.unix_date("d").alias("dia")))
    obs = daily.filter(F.col("indicador").isin(ymd))
    spine = (obs.groupBy("indicador").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
             .select("indicador", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d")))
    csv_like = (spine.join(obs, ["indicador", "d"], "left")
                .select(tabela.alias("tabela"), F.date_format("d", "yyyy-MM-dd").alias("data_txt"),
                        "valor_txt", F.unix_date("d").alias("dia")))
    return _with_faults(json_like.unionByName(csv_like))


def bronze_long(spark: SparkSession, sf_dir: str, materialise: bool = True) -> DataFrame:
    """The raw-layout series as ``(tabela, data_txt, valor_txt)``."""
    return bronze_days(spark, sf_dir, materialise).select("tabela", "data_txt", "valor_txt")


def _with_faults(rows: DataFrame) -> DataFrame:
    """Every row, and beside it on some days (by day number) a faulty one:
    a repeat, an unreadable date, an unreadable value, a negative value."""
    made = ", ".join(f"if(dia % {every} = 0, named_struct('data_txt', {date}, 'valor_txt', {value}, 'falha', {i}), NULL)"
                     for i, (every, date, value) in enumerate(FAULTS, 1))
    every_row = F.expr(f"array_compact(array(named_struct('data_txt', data_txt, 'valor_txt', valor_txt, 'falha', 0), {made}))")
    return rows.select("tabela", "dia", F.explode(every_row).alias("r")).select("tabela", "r.data_txt", "r.valor_txt", "dia", "r.falha")


def bronze_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw-layout text frames, one per Bronze table of ``SERIES``, with the
    source's own column names (``data``/``valor`` or
    ``observation_date``/``<CODE>``)."""
    long = bronze_long(spark, sf_dir)
    return {s.table: long.filter(F.col("tabela") == s.table)
            .select(F.col("data_txt").alias(s.date_col), F.col("valor_txt").alias(s.value_col))
            for s in SERIES}


def render_landing(spark: SparkSession, sf_dir: str, landing_dir: str) -> dict[str, str]:
    """Write the six raw files (JSON lines / CSV with header) into
    ``landing_dir``; returns table -> folder written. Used by the round-trip
    ingest path and by tests."""
    paths: dict[str, str] = {}
    frames = bronze_frames(spark, sf_dir)
    for spec in SERIES:
        df = frames[spec.table]
        path = f"{landing_dir.rstrip('/')}/{spec.table}"
        if spec.date_fmt == "dd/MM/yyyy":
            df.write.mode("overwrite").json(path)
        else:
            df.write.mode("overwrite").option("header", "true").csv(path)
        paths[spec.table] = path
    return paths
