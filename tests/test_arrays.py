"""Array and CSV landing files: quarantine, splitting, ledger of each file."""
import json
import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tempora.operators.clean import ledger_by_source
from tempora.plans import study
from tempora.sources.arrays import INVALID, read_csv_checked, read_json_arrays, split_quarantine
from tempora.sources.ingest import LINEAGE_FILE, LINEAGE_TS


def put(folder, name, text):
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_one_broken_record_among_good_ones(spark, tmp_path):
    put(tmp_path, "a.json", '[{"data":"02/01/2020","valor":"4.1"},\n {"data":"03/01/2020" "valor":"4.2"},\n{"data":"06/01/2020","valor":"4.3"}\n]\n')
    put(tmp_path, "b.json", "[]")
    put(tmp_path, "c.json", '[ { "data" : "07/01/2020", "valor" : null, "outro": 3 } ]')
    df = read_json_arrays(spark, str(tmp_path), ["data", "valor"], run_ts="2020-02-01")
    good, bad = split_quarantine(df)
    assert sorted(map(tuple, good.select("data", "valor").collect()), key=str) == [("02/01/2020", "4.1"), ("06/01/2020", "4.3"), ("07/01/2020", None)]
    (row,) = bad.collect()
    assert row[INVALID] == '{"data":"03/01/2020" "valor":"4.2"}' and row[LINEAGE_FILE].endswith("/a.json") and str(row[LINEAGE_TS]) == "2020-02-01 00:00:00"


def test_record_without_an_end(spark, tmp_path):
    put(tmp_path, "a.json", '[{"data":"1","valor":"1"},{"data":"2","valor":"2",{"data":"3","valor":"3"},{"data":"4","val')
    good, bad = split_quarantine(read_json_arrays(spark, str(tmp_path), ["data", "valor"]))
    assert [r.data for r in good.collect()] == ["1"] and bad.count() == 2


def test_a_large_array_file_is_split(spark, tmp_path):
    n = 20_000
    path = put(tmp_path, "big.json", "[" + ",\n".join(json.dumps({"data": f"{i:08d}", "valor": "é" * (i % 5)}) for i in range(n)) + "]")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_json_arrays(spark, path, ["data", "valor"])
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 5
        assert df.filter(f"{INVALID} is null").select("data").distinct().count() == n == df.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_csv_lines_of_another_width(spark, tmp_path):
    put(tmp_path, "x.csv", "d,v\n2020-01-01,1\n2020-01-02,\n2020-01-03,1,2\n2020-01-04\n")
    good, bad = split_quarantine(read_csv_checked(spark, str(tmp_path), ["d", "v"]))
    assert sorted(map(tuple, good.select("d", "v").collect())) == [("2020-01-01", "1"), ("2020-01-02", None)]
    assert {r[INVALID] for r in bad.collect()} == {"2020-01-03,1,2", "2020-01-04"}


def test_rendered_arrays_are_arrays(spark):
    folder = study.landing_files(spark, SF_SMALL).removeprefix("file:")
    years = 0
    for root, _, files in os.walk(os.path.join(folder, "tabela=bcb_ptax")):
        for f in files:
            if f.startswith("part-"):
                years += 1
                text = open(os.path.join(root, f), encoding="utf-8").read()
                assert text.startswith("[") and text.rstrip().endswith("]")
                rows = json.loads(text.replace('"valor" "', '"valor": "'))
                assert rows and set(rows[0]) == {"data", "valor"}
    assert years > 3


def test_ledger_of_each_source_closes(spark):
    rows = [("k", "2020-01-01", 1.0, "a", False), ("k", "2020-01-01", 2.0, "b", False), ("k", "2020-01-01", 2.0, "b", False), ("k", None, 1.0, "b", False),
            ("k", "2010-01-01", 1.0, "a", False), ("k", "2020-01-02", None, "a", False), ("k", "2020-01-02", -1.0, None, False), ("k", None, None, "c", True)]
    df = spark.createDataFrame(rows, "indicador string, data string, valor double, arquivo string, ruim boolean").withColumn("data", F.to_date("data"))
    got = {r.arquivo: r for r in ledger_by_source(df, ["indicador"], ["arquivo"], unreadable=F.col("ruim")).collect()}
    for r in got.values():
        assert r.linhas_bronze == r.ilegiveis + r.data_invalida + r.fora_periodo + r.sem_valor + r.valor_invalido + r.duplicadas + r.linhas_silver
    assert (got["a"].linhas_silver, got["a"].duplicadas, got["b"].linhas_silver, got["b"].duplicadas) == (0, 1, 1, 1)
    assert got["c"].ilegiveis == 1 and got[None].valor_invalido == 1
