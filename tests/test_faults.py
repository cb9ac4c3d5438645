"""The rendered landing rows hold every kind of fault that the cleaning rules discard."""
import __spark_entry__ as E
from tempora.operators.clean import LEDGER_RULES

SF = "/root/testdata/sf0.001"


def test_every_rule_fires(spark):
    rows = E.queries()["silver_ledger"](spark, SF).collect()
    for counter in (*LEDGER_RULES, "duplicadas"):
        assert sum(r[counter] for r in rows) > 0, counter
    for r in rows:
        assert r["linhas_bronze"] == sum(r[c] for c in LEDGER_RULES) + r["duplicadas"] + r["linhas_silver"]


def test_dimension_keeps_every_member(spark):
    rows = E.queries()["dim_indicator"](spark, SF).collect()
    assert len(rows) == 6 and all(r["linhas_silver"] > 0 for r in rows)
