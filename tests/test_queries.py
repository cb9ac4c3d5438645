"""Every registered query against its DuckDB oracle at sf0.001 (the driver
checks sf0.01), plus plan properties of the registered queries."""
import decimal
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tempora.plans import catalog

TABLES = ["orders", "lineitem", "events", "customer", "nation", "region", "supplier", "part"]
SQL = E.oracle_sql()
QUERIES = E.queries()
OWN = {n for n in QUERIES if n != "pipeline" and not re.match(r"op\d+_", n)}  # the corpus queries have their own tests


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _key(row):
    return tuple("" if v is None else str(v) if not isinstance(v, (int, float)) else f"{v:.6e}" for v in row)


def test_every_query_has_an_oracle_or_is_documented():
    assert set(SQL) <= set(QUERIES)
    assert OWN - set(SQL) == {"manifest_check"}


def test_documented_tables(spark):
    rows = QUERIES["documented_tables"](spark, SF_SMALL).collect()
    assert len({r.tabela for r in rows}) == 4 and sum(r.tabela == "fato_janela_cambial" for r in rows) == 36
    by = {r.col_name: r.comment for r in catalog.column_comments(spark, "gold.fato_janela_cambial").collect()}
    assert by["maior_alta_90d_pct"].startswith("Largest rise")


@pytest.mark.parametrize("name", sorted(set(SQL) & OWN))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=_key), sorted(want, key=_key)):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, (int, float)):
                assert abs(x - y) <= 1e-6 * max(1.0, abs(x)), (name, a, b)
            else:
                assert x == y, (name, a, b)


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ano" in df.columns


def test_manifest_check(spark):
    rows = QUERIES["manifest_check"](spark, SF_SMALL).collect()
    assert len(rows) == 6 and all(r.arquivos > 0 and r.bytes > 0 for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_scan_pushdown_and_pruning(spark):
    from tempora.sources.fixtures import daily_series
    plan = daily_series(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderpriority" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    assert plan.count("FileScan parquet") == 2   # one scan per source table
