"""Silver cleaning (C2, C3): catalogue-driven parsing of raw text and an
ordered rule waterfall that accounts for every discarded row.

One labelled pass replaces a count action per rule: each row gets the name
of the *first* rule it fails (or NULL when it passes all of them). Survivors
are de-duplicated on ``keys + [date]`` with a stated tie-break, and the
ledger sums the per-group label counts. Both outputs come from one aggregate
over the input.

De-duplication is an aggregate (``max_by`` over a tie-break struct), not a
window, so partial aggregation runs map-side: a date or key holding a third
of all rows is combined in every task before the shuffle instead of landing
whole in one task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.plans.series_catalogue import LEDGER_RULES, SeriesSpec
from tempora.sources.ingest import LINEAGE_TS

RULE = "_regra"


def parse_text(df: DataFrame, date_col: str, date_fmt: str, value_col: str,
               decimal_type: str = "decimal(18,6)") -> tuple[Column, Column]:
    """Safe typed views of raw text: bad date / bad number -> NULL.

    ``' 3.2729 '`` -> 3.272900; ``''``, ``'.'``, ``'3,27'`` -> NULL.
    """
    d = F.try_to_date(F.col(f"`{date_col}`"), date_fmt)
    v = F.trim(F.col(f"`{value_col}`")).try_cast(decimal_type)
    return d, v


def normalise_long(long: DataFrame, specs: Sequence[SeriesSpec], table_col: str = "tabela",
                   date_col: str = "data_txt", value_col: str = "valor_txt",
                   decimal_type: str = "decimal(18,6)", keep: Sequence[Column] = ()) -> DataFrame:
    """Typed long table ``(data, indicador, valor, fonte, unidade
    [, _data_ingestao])`` from a stacked raw table ``(tabela, date text,
    value text)`` (C3). One pass: each row is parsed with its own source's
    date format via a CASE over the catalogue. Rows are only parsed here;
    nothing is dropped yet (see ``waterfall``). ``keep``: further columns."""
    t = F.col(table_col)

    def case(then) -> Column:
        # one CASE over the catalogue, as SQL text (a single expression to analyse)
        arms = " ".join(f"WHEN `{table_col}` = {_sql_str(s.table)} THEN {then(s)}" for s in specs)
        return F.expr(f"CASE {arms} END")

    cols = [case(lambda s: f"try_to_date(`{date_col}`, {_sql_str(s.date_fmt)})").alias("data"),
            case(lambda s: _sql_str(s.code)).alias("indicador"),
            F.trim(F.col(f"`{value_col}`")).try_cast(decimal_type).alias("valor"),
            case(lambda s: _sql_str(s.source)).alias("fonte"),
            case(lambda s: _sql_str(s.unit)).alias("unidade")]
    if LINEAGE_TS in long.columns:
        cols.append(F.col(LINEAGE_TS))
    listed = t.isin([s.table for s in specs])
    known = F.when(listed, True).otherwise(F.raise_error(F.concat(F.lit("source not in the catalogue: "), F.coalesce(t, F.lit("NULL")))).cast("boolean"))
    return long.filter(known).select(*cols, *keep)


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def normalise(frames: dict[str, DataFrame], specs: Sequence[SeriesSpec]) -> DataFrame:
    """Stack per-source raw tables (each with its own column names) and parse
    them in one pass (C3): each frame is only renamed to
    ``(tabela, data_txt, valor_txt[, _data_ingestao])`` before the union."""
    parts = []
    for s in specs:
        src = frames[s.table]
        cols = [F.lit(s.table).alias("tabela"), F.col(f"`{s.date_col}`").alias("data_txt"),
                F.col(f"`{s.value_col}`").alias("valor_txt")]
        if LINEAGE_TS in src.columns:
            cols.append(F.col(LINEAGE_TS))
        parts.append(src.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return normalise_long(out, specs)


def label_rules(df: DataFrame, date: str = "data", value: str = "valor",
                cutoff: str | _dt.date = "2017-01-01") -> DataFrame:
    """Attach the first failing rule: date NULL -> date before cutoff ->
    value NULL -> value <= 0. NULL label = row passes."""
    cut = F.lit(cutoff).cast("date") if not isinstance(cutoff, Column) else cutoff
    rule = (F.when(F.col(date).isNull(), LEDGER_RULES[0])
            .when(F.col(date) < cut, LEDGER_RULES[1])
            .when(F.col(value).isNull(), LEDGER_RULES[2])
            .when(F.col(value) <= 0, LEDGER_RULES[3]))
    return df.withColumn(RULE, rule)


def _tie_break(df: DataFrame, value: str, tie_break: Sequence[str] | None) -> Column:
    order = list(tie_break) if tie_break else (
        [LINEAGE_TS, value] if LINEAGE_TS in df.columns else [value])
    return F.struct(*[F.col(c) for c in order])


def waterfall(df: DataFrame, keys: Sequence[str] = ("indicador",), date: str = "data",
              value: str = "valor", cutoff="2017-01-01",
              tie_break: Sequence[str] | None = None, materialise=None) -> tuple[DataFrame, DataFrame]:
    """Ordered cleaning with a discard ledger.

    Returns ``(clean, ledger)``. ``clean`` keeps the input columns, one row
    per ``keys + [date]``: among duplicates it keeps the row with the largest
    ``tie_break`` struct (default: latest ingestion time, then largest
    value). ``ledger`` has one row per key with ``linhas_bronze``, one
    counter per rule, ``duplicadas`` and ``linhas_silver``; the counters
    always add up: bronze = sum(rules) + duplicadas + silver.

    One pass over the input: a single aggregate grouped by ``keys + [date]``
    (partial aggregation map-side, so a hot key or date is combined in every
    task) yields the surviving row and the per-rule counts of each group;
    ``clean`` and ``ledger`` are both projections of that aggregate, whose
    size is the Silver grain. Pass ``materialise`` (e.g. ``cut_lineage``) to
    write it once when both outputs are used."""
    keys = list(keys)
    labelled = label_rules(df, date, value, cutoff)
    payload_cols = list(df.columns)
    grain = keys + [date]
    others = [c for c in payload_cols if c not in grain]
    valid = F.col(RULE).isNull()
    # rows failing a rule get a NULL ordering, which max_by skips
    pick = F.max_by(F.struct(*[F.col(c) for c in others]),
                    F.when(valid, _tie_break(df, value, tie_break)))
    per_grain = labelled.groupBy(*grain).agg(
        pick.alias("_row"),
        F.count("*").alias("_n"),
        F.count_if(valid).alias("_n_valid"),
        *[F.count_if(F.col(RULE) == r).alias(r) for r in LEDGER_RULES])
    if materialise is not None:
        per_grain = materialise(per_grain)

    clean = (per_grain.filter(F.col("_n_valid") > 0)
             .select(*[F.col(c) for c in grain], *[F.col(f"_row.{c}").alias(c) for c in others])
             .select(*payload_cols))
    ledger = per_grain.groupBy(*keys).agg(
        F.sum("_n").cast("bigint").alias("linhas_bronze"),
        *[F.sum(r).cast("bigint").alias(r) for r in LEDGER_RULES],
        F.sum(F.greatest(F.col("_n_valid") - 1, F.lit(0))).cast("bigint").alias("duplicadas"),
        F.count_if(F.col("_n_valid") > 0).alias("linhas_silver"))
    return clean, ledger


def ledger_by_source(df: DataFrame, keys: Sequence[str], source: Sequence[str], date: str = "data", value: str = "valor",
                     cutoff="2017-01-01", unreadable: Column | None = None, materialise=None) -> DataFrame:
    """The discard ledger per key and source of the rows (file, load, ...):
    every row is counted where it came from, and the surviving row of a date is
    counted in its own source. ``unreadable`` marks rows that could not be read
    at all; they are counted first, as ``ilegiveis``. The counters add up:
    bronze = ilegiveis + sum(rules) + duplicadas + silver, in every source.

    One aggregate by key, date and source (map-side combined); the survivor of
    a date is then chosen among the few sources that hold it."""
    keys, source = list(keys), list(source)
    lost = F.lit(False) if unreadable is None else unreadable
    labelled = label_rules(df, date, value, cutoff).withColumn("_lost", lost)
    valid = F.col(RULE).isNull() & ~F.col("_lost")
    per = labelled.groupBy(*keys, date, *source).agg(
        F.count("*").alias("_n"), F.count_if("_lost").alias("_n_lost"), F.count_if(valid).alias("_n_valid"),
        *[F.count_if((F.col(RULE) == r) & ~F.col("_lost")).alias(r) for r in LEDGER_RULES],
        F.max(F.when(valid, F.struct(*([F.col(LINEAGE_TS)] if LINEAGE_TS in df.columns else []), F.col(value)))).alias("_best"))
    if materialise is not None:
        per = materialise(per)
    tie = F.struct("_best", *source)
    chosen = (per.filter("_n_valid > 0").groupBy(*keys, date).agg(F.max_by(F.struct(*source), tie).alias("_s"))
              .groupBy(*keys, *[F.col(f"_s.{c}").alias(c) for c in source]).agg(F.count("*").alias("linhas_silver")))
    sums = per.groupBy(*keys, *source).agg(
        F.sum("_n").cast("bigint").alias("linhas_bronze"), F.sum("_n_lost").cast("bigint").alias("ilegiveis"),
        *[F.sum(r).cast("bigint").alias(r) for r in LEDGER_RULES], F.sum("_n_valid").cast("bigint").alias("_valid"))
    on = [*keys, *source]
    kept = chosen.withColumnsRenamed({c: f"_on_{c}" for c in on})
    j = sums.join(kept, [sums[c].eqNullSafe(kept[f"_on_{c}"]) for c in on], "left")
    silver = F.coalesce("linhas_silver", F.lit(0).cast("bigint"))
    return j.select(*on, "linhas_bronze", "ilegiveis", *LEDGER_RULES, (F.col("_valid") - silver).alias("duplicadas"), silver.alias("linhas_silver"))


def dedup_latest(df: DataFrame, grain: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per ``grain``: the one with the largest ``order`` struct.
    Aggregate-based (map-side combine), safe for hot keys."""
    others = [c for c in df.columns if c not in grain]
    return (df.groupBy(*grain)
            .agg(F.max_by(F.struct(*[F.col(c) for c in others]),
                           F.struct(*[F.col(c) for c in order])).alias("_row"))
            .select(*grain, *[F.col(f"_row.{c}").alias(c) for c in others])
            .select(*df.columns))
