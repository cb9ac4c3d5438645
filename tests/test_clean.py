"""Waterfall cleaning and parsing on hand-made micro-frames."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tempora.operators.clean import normalise, waterfall
from tempora.plans.series_catalogue import SeriesSpec

SPEC = [SeriesSpec("raw_a", "A", "d", "dd/MM/yyyy", "v", "src", "unit"),
        SeriesSpec("raw_b", "B", "observation_date", "yyyy-MM-dd", "B", "src-b", "u-b")]


def frames(spark, rows_a, rows_b=()):
    a = spark.createDataFrame(list(rows_a), "d string, v string")
    b = spark.createDataFrame(list(rows_b), "observation_date string, B string")
    return {"raw_a": a, "raw_b": b}


def test_parse_values(spark):
    f = frames(spark, [("02/01/2020", " 3.2729 "), ("03/01/2020", ""), ("06/01/2020", "."),
                       ("07/01/2020", "3,27")])
    rows = {r.data: r.valor for r in normalise(f, SPEC).collect()}
    assert rows[dt.date(2020, 1, 2)] == Decimal("3.272900")
    assert rows[dt.date(2020, 1, 3)] is None
    assert rows[dt.date(2020, 1, 6)] is None
    assert rows[dt.date(2020, 1, 7)] is None


def test_first_failing_rule_owns_the_row(spark):
    # bad date AND blank value -> counted only as a bad date
    f = frames(spark, [("31/02/2020", ""), ("01/01/2010", "1.0"), ("02/01/2020", None),
                       ("03/01/2020", "0"), ("06/01/2020", "-1"), ("07/01/2020", "2.5")])
    clean, ledger = waterfall(normalise(f, SPEC), ["indicador"], cutoff="2017-01-01")
    led = ledger.filter(F.col("indicador") == "A").first().asDict()
    assert led == {"indicador": "A", "linhas_bronze": 6, "data_invalida": 1, "fora_periodo": 1,
                   "sem_valor": 1, "valor_invalido": 2, "duplicadas": 0, "linhas_silver": 1}
    assert clean.count() == 1


def test_duplicates_tie_break(spark):
    f = frames(spark, [("02/01/2020", "1.5"), ("02/01/2020", "2.5"), ("02/01/2020", "0.5")],
               [("2020-01-02", "7"), ("2020-01-03", "8")])
    clean, ledger = waterfall(normalise(f, SPEC), ["indicador"], cutoff="2017-01-01")
    a = clean.filter(F.col("indicador") == "A").collect()
    assert len(a) == 1 and a[0].valor == Decimal("2.500000")   # largest value wins the tie
    led = {r.indicador: r for r in ledger.collect()}
    assert led["A"].duplicadas == 2 and led["A"].linhas_silver == 1
    assert led["B"].duplicadas == 0 and led["B"].linhas_silver == 2
    assert clean.filter(F.col("indicador") == "B").first().fonte == "src-b"


def test_ledger_adds_up(spark):
    f = frames(spark, [(f"{d:02d}/01/2020", str(d % 3)) for d in range(1, 29)] + [("xx", "1")],
               [("2020-01-01", ""), ("2016-12-31", "4"), ("2020-01-02", "5"), ("2020-01-02", "6")])
    clean, ledger = waterfall(normalise(f, SPEC), ["indicador"], cutoff="2017-01-01")
    for r in ledger.collect():
        parts = r.data_invalida + r.fora_periodo + r.sem_valor + r.valor_invalido + r.duplicadas
        assert r.linhas_bronze == parts + r.linhas_silver
    assert clean.count() == sum(r.linhas_silver for r in ledger.collect())


def test_empty_input(spark):
    f = frames(spark, [])
    clean, ledger = waterfall(normalise(f, SPEC), ["indicador"])
    assert clean.count() == 0 and ledger.count() == 0
