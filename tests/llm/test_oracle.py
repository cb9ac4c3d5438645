"""The corpus queries against their DuckDB SQL over a whole test table."""
from collections import Counter

import duckdb
import pytest

from tempora.llm import queries as corpus

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(corpus.oracle_sql()[name])
    cols = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in cols]
    got = corpus.queries()[name](spark, SF)
    assert sorted(got.columns) == cols
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == Counter(tuple(r[i] for i in at) for r in want.fetchall())
