"""The batch job publishes every layer under its catalog name."""
from conftest import SF_SMALL
from tempora.plans import job


def test_run_publishes_layers(spark):
    out = job.run(spark, SF_SMALL)
    assert spark.table("gold.fato_janela_cambial").count() == out["gold.fato_janela_cambial"].count() > 0
    assert len(spark.table("gold.fato_janela_cambial").columns) == 36
    led = spark.table("silver.controle_qualidade").collect()
    assert all(r.linhas_bronze == r.data_invalida + r.fora_periodo + r.sem_valor + r.valor_invalido
               + r.duplicadas + r.linhas_silver for r in led)
    assert all(r.diferenca_bronze_silver == 0 and r.diferenca_silver_gold == 0
               for r in out["dq.reconcile"].collect())
    n = spark.sql("SELECT COUNT(*) AS n FROM gold.fato_janela_cambial f "
                  "LEFT ANTI JOIN gold.dim_tempo d ON f.data = d.data").first().n
    assert n == 0
    assert out["report.forward_vs_call"].count() == 3
    b = spark.table("bronze.bcb_ptax").first()
    assert "/bcb_ptax/" in b._arquivo_origem and b._data_ingestao is not None
    assert all(r.presente for r in out["bronze.manifest"].collect())


def test_run_from_array_files(spark):
    """The same Silver from array and CSV files by year; what cannot be read is kept aside and counted."""
    plain = {tuple(r) for r in job.run(spark, SF_SMALL, document=False)["silver.serie_diaria"].select("data", "indicador", "valor").collect()}
    out = job.run(spark, SF_SMALL, document=False, files=True)
    assert {tuple(r) for r in out["silver.serie_diaria"].select("data", "indicador", "valor").collect()} == plain
    led = spark.table("silver.controle_por_arquivo").collect()
    assert all(r.linhas_bronze == r.ilegiveis + r.data_invalida + r.fora_periodo + r.sem_valor + r.valor_invalido
               + r.duplicadas + r.linhas_silver for r in led)
    assert sum(r.ilegiveis for r in led) == spark.table("bronze.quarentena").count() > 0
    assert sum(r.linhas_silver for r in led) == len(plain)
    assert spark.table("bronze.quarentena").select("arquivo").distinct().count() > 6
