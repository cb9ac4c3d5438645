"""Quality checks on positive cases (orphans, ranges, gaps, lag, nulls, grain)."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tempora.operators import quality as Q
from tempora.plans import gold, study
from tempora.sources.fixtures import read_table


def test_orphans_positive_case(spark):
    orders = read_table(spark, SF_SMALL, "orders")
    customer = read_table(spark, SF_SMALL, "customer")
    kept = customer.filter(F.col("c_custkey") % 2 == 0)       # drop half the dimension
    o = orders.select(F.col("o_custkey").alias("c_custkey"))
    got = Q.orphans({"orders -> customer (half)": (o, kept, "c_custkey"),
                     "orders -> customer": (o, customer, "c_custkey")}).collect()
    by = {r.relacao: r.orfaos for r in got}
    expect = o.filter(F.col("c_custkey") % 2 == 1).count()
    assert by["orders -> customer (half)"] == expect > 0 and by["orders -> customer"] == 0


def test_range_gaps_lag(spark):
    rows = [(dt.date(2020, 1, d), "X", v) for d, v in [(1, 1.0), (2, 9.0), (10, 5.0), (11, 0.5)]] + \
           [(dt.date(2020, 1, d), "R", 2.0) for d in (1, 2, 3, 13)]
    s = spark.createDataFrame(rows, "data date, indicador string, valor double")
    bounds = spark.createDataFrame([("X", 1.0, 8.0), ("R", 0.0, 10.0)],
                                   "indicador string, minimo_esperado double, maximo_esperado double")
    r = {x.indicador: x for x in Q.range_check(s, bounds).collect()}
    assert r["X"].fora_da_faixa == 2 and r["X"].minimo_obs == 0.5 and r["R"].fora_da_faixa == 0
    g = {x.indicador: x for x in Q.gaps(s).collect()}
    assert g["X"].maior_intervalo_dias == 8 and g["X"].intervalos_acima_4_dias == 1
    assert g["R"].maior_intervalo_dias == 10
    lag = {x.indicador: x.dias_atras_da_ptax for x in Q.publication_lag(s, "R").collect()}
    assert lag == {"R": 0, "X": 2}


def test_null_profile_and_grain(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (2, None)], "k int, v string")
    prof = {r.coluna: (r.nulos, r.pct_nulos) for r in Q.null_profile(df).collect()}
    assert prof == {"k": (0, 0.0), "v": (2, 66.67)}
    u = {r.tabela: r.duplicadas for r in Q.uniqueness({"t (k)": (df, ["k"]), "t (k, v)": (df, ["k", "v"])}).collect()}
    assert u == {"t (k)": 1, "t (k, v)": 2}        # rows with a NULL grain part are not distinct keys


def test_reconcile_closes_on_the_study(spark):
    s, ledger = study.silver(spark, SF_SMALL)
    rows = Q.reconcile(ledger, gold.daily_fact(s)).collect()
    assert len(rows) == 6
    assert all(r.diferenca_bronze_silver == 0 and r.diferenca_silver_gold == 0 for r in rows)
    assert sum(r.descartadas for r in rows) > 0
