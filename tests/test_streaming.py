"""Incremental Bronze load picks up only new files."""
import os
import tempfile

import pytest

from tempora.streaming.ingest import ingest_available_now


@pytest.mark.parametrize("own", [True, False])
def test_available_now_is_incremental(spark, own):
    root = tempfile.mkdtemp(prefix="tempora-stream-")
    landing, target, ckpt = (os.path.join(root, n) for n in ("landing", "bronze", "ckpt"))
    os.makedirs(landing)
    ckpt = ckpt if own else None   # by default the checkpoint follows the target
    with open(os.path.join(landing, "a.csv"), "w") as fh:
        fh.write("observation_date,VIXCLS\n2020-01-02,12.47\n2020-01-03,\n")
    ingest_available_now(spark, landing, "csv", ["observation_date", "VIXCLS"], target, ckpt, header="true")
    assert spark.read.parquet(target).count() == 2
    with open(os.path.join(landing, "b.csv"), "w") as fh:
        fh.write("observation_date,VIXCLS\n2020-01-06,13.1\n")
    ingest_available_now(spark, landing, "csv", ["observation_date", "VIXCLS"], target, ckpt, header="true")
    df = spark.read.parquet(target)
    assert df.count() == 3
    assert {r._arquivo_origem.rsplit("/", 1)[-1] for r in df.collect()} == {"a.csv", "b.csv"}
