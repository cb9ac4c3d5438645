import pytest
"""Session helpers: the shared folder comes from the session; scale settings."""
from tempora.session import SCALE_CONF, configure_for_scale, cut_lineage, ensure_checkpoint_dir, scratch_path


def test_layers_go_to_the_checkpoint_folder(spark):
    root = ensure_checkpoint_dir(spark)
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/x-")
    df = cut_lineage(spark.range(5), "probe")
    assert df.count() == 5
    from urllib.parse import urlparse
    base = urlparse(root).path.rstrip("/")
    assert all(urlparse(f).path.startswith(base + "/probe-") for f in df.inputFiles())


def test_configure_for_scale(spark):
    before = {k: spark.conf.get(k) for k in SCALE_CONF}
    try:
        configure_for_scale(spark, {"spark.sql.shuffle.partitions": "16"})
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_layers_after_a_mark_are_deleted(spark):
    from tempora.session import clear_layers, cut_lineage, layer_mark
    first = cut_lineage(spark.range(3), "kept")
    mark = layer_mark()
    gone = cut_lineage(spark.range(4), "gone")
    assert gone.count() == 4 and clear_layers(spark, mark) == 1
    assert first.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(gone.inputFiles()[0]).count()
