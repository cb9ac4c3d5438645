"""Ordered-block windows and bucketed forward fill equal the plain windows."""
import random

import pytest
from pyspark.sql import functions as F

from tempora.operators.windows import Win, WindowPlan, ffill, over

SPECS = [Win("lag1", "lag", "v", offset=1), Win("lag5", "lag", "v", offset=5),
         Win("lead21", "lead", "v", offset=21), Win("sd21", "stddev", "v", -20, 0),
         Win("mm63", "avg", "v", -62, 0), Win("mn252", "min", "v", -251, 0),
         Win("mx_fwd", "max", "v", 1, 21)]


@pytest.fixture(scope="module")
def series(spark):
    random.seed(7)
    rows = []
    for k in range(3):
        n = [1500, 40, 700][k]
        for i in range(n):
            v = None if random.random() < 0.1 else round(random.uniform(1, 100), 3)
            rows.append((k, i, i // 31, v))
    return spark.createDataFrame(rows, "k int, t int, b int, v double")


def _order(row):
    return [(v is None, 0 if v is None else v) for v in row]


def _same(a, b, cols):
    x = sorted((tuple(r) for r in a.select(*cols).collect()), key=_order)
    y = sorted((tuple(r) for r in b.select(*cols).collect()), key=_order)
    assert len(x) == len(y)
    for r, s in zip(x, y):
        for u, w in zip(r, s):
            assert (u is None and w is None) or abs(u - w) <= 1e-9 * max(1, abs(u))


def test_block_equals_keyed(spark, series):
    plain = over(series, ["k"], ["t"], SPECS)
    blocked = over(series, ["k"], ["t"], SPECS, block_rows=300, bucket="b")
    _same(plain, blocked, ["k", "t"] + [s.name for s in SPECS])


def test_block_without_keys(spark, series):
    one = series.filter(F.col("k") == 0)
    plain = over(one, [], ["t"], SPECS)
    blocked = over(one, [], ["t"], SPECS, block_rows=320, bucket="b")
    _same(plain, blocked, ["t"] + [s.name for s in SPECS])
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_blk" in plan


def test_dependent_stages_in_one_plan(spark, series):
    plan = WindowPlan(series, ["k"], ["t"], 300, bucket="b", pre=21, post=0)
    x = plan.df.withColumn("r", F.col("v") - F.lag("v").over(plan.base))
    x = plan.finish(x.withColumn("sd", F.stddev_samp("r").over(plan.frame(-20, 0))))
    ref = series.withColumn("r", F.col("v") - F.lag("v").over(WindowPlan(series, ["k"], ["t"]).base))
    ref = ref.withColumn("sd", F.stddev_samp("r").over(WindowPlan(series, ["k"], ["t"]).frame(-20, 0)))
    _same(x, ref, ["k", "t", "r", "sd"])


def test_ffill_bucketed_equals_running(spark, series):
    a = ffill(series, ["k"], ["t"], ["v"])
    b = ffill(series, ["k"], ["t"], ["v"], bucket="b")
    _same(a, b, ["k", "t", "v"])


def test_ffill_never_looks_ahead(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 7.0), (5, None)], "t int, v double")
    got = {r.t: r.v for r in ffill(df, [], ["t"], ["v"], bucket=F.floor(F.col("t") / 2)).collect()}
    assert got == {1: None, 2: 5.0, 3: 5.0, 4: 7.0, 5: 7.0}


def test_halo_too_large(spark, series):
    with pytest.raises(ValueError):
        over(series, ["k"], ["t"], SPECS, block_rows=100, bucket="b")


def test_range_numbering_equals_keyed(spark, series):
    plain = over(series, ["k"], ["t"], SPECS)
    ranged = over(series, ["k"], ["t"], SPECS, block_rows=400)          # no bucket: range numbering
    _same(plain, ranged, ["k", "t"] + [s.name for s in SPECS])
    one = series.filter(F.col("k") == 0)
    _same(over(one, [], ["t"], SPECS), over(one, [], ["t"], SPECS, block_rows=330),
          ["t"] + [s.name for s in SPECS])


def test_row_numbers_dense(spark, series):
    from tempora.operators.windows import row_numbers
    got = row_numbers(series, ["k"], ["t"]).select("k", "t", "_rn").collect()
    assert all(r._rn == r.t for r in got)          # t runs 0..n-1 within each key


def test_ffill_blocks_equals_running(spark, series):
    _same(ffill(series, ["k"], ["t"], ["v"]), ffill(series, ["k"], ["t"], ["v"], block_rows=200),
          ["k", "t", "v"])


def test_blocks_equal_keyed_with_a_null_key(spark, series):
    from tempora.plans.keyed import rolling_metrics
    df = series.withColumn("v", F.coalesce("v", F.lit(1.0))).withColumn("k", F.when(F.col("k") != 0, F.col("k")))   # a NULL key
    cols = ["k", "t", "valor", "ret", "vol_21", "mm_63", "min_252", "max_252", "valor_futuro", "maior_alta_pct"]
    plain = rolling_metrics(df, ["k"], ["t"], "v", block_rows=None)
    split = rolling_metrics(df, ["k"], ["t"], "v", block_rows=400)   # k=0, k=2 span blocks
    _same(plain, split, cols)
