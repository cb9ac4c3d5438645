"""The wide fact with a key equals the un-keyed wide fact computed per key,
for both window strategies."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tempora.plans import gold, study


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_keyed_wide_fact_equals_per_key(spark):
    s = study.silver(spark, SF_SMALL)[0]
    other = s.withColumn("valor", (F.col("valor") * 2).cast("decimal(18,6)")) \
             .filter(F.dayofmonth("data") != 7)           # a different calendar for key B
    keyed = s.withColumn("k", F.lit("A")).unionByName(other.withColumn("k", F.lit("B")))
    cols = ["data", "ptax", "cdi", "ret_ptax", "vol_21d_anual_pct", "mm_63d", "posicao_faixa_252d",
            "regime_vol", "faixa_252d", "ptax_em_90d", "maior_alta_30d_pct", "fwd_teorico_60d"]
    for block_rows in (None, 400):
        kw = gold.wide_fact(keyed, block_rows=block_rows, keys=["k"])
        for k, src in (("A", s), ("B", other)):
            one = gold.wide_fact(src, block_rows=None)
            got = _rows(kw.filter(F.col("k") == k), cols)
            want = _rows(one, cols)
            assert len(got) == len(want)
            for a, b in zip(got, want):
                for x, y in zip(a, b):
                    if isinstance(x, float):
                        assert y is not None and abs(x - y) <= 1e-9 * max(1.0, abs(x))
                    else:
                        assert x == y


def test_regime_shares_near_thirds(spark):
    w = study.wide(spark, SF_SMALL)
    counts = {r.regime_vol: r["count"] for r in w.groupBy("regime_vol").count().collect()}
    n = sum(v for k, v in counts.items() if k is not None)
    for label in ("1-Baixa", "2-Média", "3-Alta"):
        assert abs(counts[label] / n - 1 / 3) < 0.02


def test_rerun_gives_equal_tables(spark):
    a = study.wide(spark, SF_SMALL, materialise=False)
    b = study.wide(spark, SF_SMALL, materialise=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_keyed_block_plan_has_no_single_partition(spark):
    from tempora.plans.keyed import rolling_metrics
    from tempora.sources.fixtures import read_table
    ev = read_table(spark, SF_SMALL, "events")
    # every user above the threshold: the block path
    df = rolling_metrics(ev, ["user_id"], ["ts", "event_id"], "value", block_rows=4096,
                         value_scale=2)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "windowspecdefinition(user_id#" in plan and "_blk" in plan
