"""Raw ingest with lineage, the landing manifest, and catalog documentation."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tempora.plans.catalog import (column_comments, comment_schema, create_schema, document,
                                   horizon_comments, list_schemas, list_tables)
from tempora.sources.ingest import assert_manifest, ingest, manifest


def test_csv_and_json_ingest(spark):
    d = tempfile.mkdtemp(prefix="tempora-test-")
    with open(os.path.join(d, "VIXCLS.csv"), "w") as fh:
        fh.write("observation_date,VIXCLS\n2020-01-02,12.47\n2020-01-03,\n")
    with open(os.path.join(d, "ptax.json"), "w") as fh:
        fh.write('[{"data": "02/01/2020", "valor": "4.0213"}, {"data": "03/01/2020", "valor": "4.0522"}]')
    csv = ingest(spark, os.path.join(d, "VIXCLS.csv"), "csv", ["observation_date", "VIXCLS"],
                 run_ts="2026-09-27 00:00:00", header="true")
    rows = csv.orderBy("observation_date").collect()
    assert [r.VIXCLS for r in rows] == ["12.47", None]          # empty cell -> NULL
    assert rows[0]._arquivo_origem.endswith("VIXCLS.csv")
    assert str(rows[0]._data_ingestao).startswith("2026-09-27")
    js = ingest(spark, os.path.join(d, "ptax.json"), "json", ["data", "valor"], multiLine="true")
    assert {f.dataType.simpleString() for f in js.schema.fields[:2]} == {"string"}
    assert js.count() == 2
    m = manifest(spark, d, ["VIXCLS.csv", "ptax.json"])
    assert_manifest(m)
    with pytest.raises(FileNotFoundError):
        assert_manifest(manifest(spark, d, ["VIXCLS.csv", "DFF.csv"]))


def test_document_table(spark):
    create_schema(spark, "tempora_test_gold", "Gold layer (test)")
    df = spark.range(3).select(F.col("id").alias("data"), (F.col("id") * 2).alias("ptax_em_30d"))
    df.write.mode("overwrite").format("parquet").saveAsTable("tempora_test_gold.t")
    cols = {"data": "Day key. It's quoted."}
    cols.update(horizon_comments({"ptax_em_{dc}d": "Level {dc} days later."}))
    document(spark, "tempora_test_gold.t", "A 'test' table", cols)
    got = {r.col_name: r.comment for r in column_comments(spark, "tempora_test_gold.t").collect()}
    assert got["data"] == "Day key. It's quoted."
    assert got["ptax_em_30d"] == "Level 30 days later."
    assert "tempora_test_gold" in {r[0] for r in list_schemas(spark).collect()}
    assert [r.tableName for r in list_tables(spark, "tempora_test_gold").collect()] == ["t"]
    comment_schema(spark, "tempora_test_gold", "Gold layer (renamed)")
    desc = {r[0]: r[1] for r in spark.sql("DESCRIBE SCHEMA tempora_test_gold").collect()}
    assert desc.get("Comment") == "Gold layer (renamed)"
    spark.sql("DROP TABLE tempora_test_gold.t")
