"""Edge cases of the wide-fact metrics, regimes, bands and pricing."""
import datetime as dt
import math

from pyspark.sql import functions as F

from tempora.functions import metrics as M
from tempora.functions.pricing import erf, erf_nonneg, fx_call_premium
from tempora.plans import gold


def _silver(spark, ptax, others=None):
    """Long silver rows: PTAX on consecutive days, other series optional."""
    rows = []
    d0 = dt.date(2020, 1, 1)
    for i, v in enumerate(ptax):
        rows.append((d0 + dt.timedelta(days=i), "PTAX_VENDA", v))
    for code, pts in (others or {}).items():
        for day, v in pts:
            rows.append((d0 + dt.timedelta(days=day), code, v))
    return spark.createDataFrame(rows, "data date, indicador string, valor double") \
        .withColumn("valor", F.col("valor").cast("decimal(18,6)"))


def test_vol_needs_two_returns(spark):
    w = gold.wide_fact(_silver(spark, [1.0, 1.1, 1.2, 1.3]), block_rows=None).orderBy("data").collect()
    assert w[0].vol_21d_anual_pct is None and w[1].vol_21d_anual_pct is None
    assert w[2].vol_21d_anual_pct is not None


def test_constant_series(spark):
    w = gold.wide_fact(_silver(spark, [2.0] * 30), block_rows=None)
    assert w.filter(F.col("posicao_faixa_252d").isNotNull()).count() == 0
    c = w.agg(M.safe_corr("ret_ptax", "ptax").alias("c")).first().c
    assert c is None


def test_forward_columns_null_at_the_end(spark):
    n = 120
    w = gold.wide_fact(_silver(spark, [1 + i / 100 for i in range(n)]), block_rows=None).orderBy("data").collect()
    tail = w[-63:]
    assert all(r.ptax_em_90d is None and r.maior_alta_90d_pct is None for r in tail)
    assert tail[0].ptax_em_30d is not None and tail[-1].ptax_em_30d is None
    # maior_alta is NULL iff the future level is NULL
    assert all((r.maior_alta_30d_pct is None) == (r.ptax_em_30d is None) for r in w)


def test_band_edges_and_regime_ties(spark):
    df = spark.createDataFrame([(0.25,), (0.75,), (0.5,), (None,)], "x double")
    got = [r.b for r in df.select(M.band("x", 0.25, 0.75, ("lo", "mid", "hi")).alias("b")).collect()]
    assert got == ["lo", "hi", "mid", None]
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    got = [r.b for r in df.select(M.cut_buckets("x", [1.0, 2.0], ("a", "b", "c")).alias("b")).collect()]
    assert got == ["a", "b", "c", None]


def test_alignment_no_backfill_no_lookahead(spark):
    # CDI first published on day 3, then on day 6; PTAX every day
    s = _silver(spark, [1.0 + i / 10 for i in range(8)], {"CDI": [(3, 10.0), (6, 12.0)]})
    a = {r.data.day: r.cdi for r in gold.align_last_known(s).collect()}
    assert a[1] is None and a[3] is None            # before the first value: NULL
    assert a[4] == 10.0 and a[6] == 10.0            # day 4..6 see day 3's value
    assert a[7] == 12.0                             # published day 6 -> used from day 7


def test_erf_against_math(spark):
    xs = [i / 20 for i in range(0, 161)] + [6.5, 9.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select("x", erf_nonneg("x").alias("e"), erf(-F.col("x")).alias("m")).collect()
    for r in got:
        assert abs(r.e - math.erf(r.x)) < 1e-12
        assert abs(r.m + math.erf(r.x)) < 1e-12


def test_call_premium_matches_closed_form(spark):
    df = spark.createDataFrame([(5.0, 15.0, 10.0)], "fwd double, vol double, cdi double")
    t = 63 / 252
    got = df.select(fx_call_premium("fwd", "vol", "cdi", t).alias("p")).first().p
    s = 0.15 * math.sqrt(t)
    n = lambda x: 0.5 * (1 + math.erf(x / math.sqrt(2)))
    want = math.exp(-math.log(1.1) * t) * 5.0 * (n(s / 2) - n(-s / 2))
    assert abs(got - want) < 1e-12


def test_parity_forward(spark):
    df = spark.createDataFrame([(5.0, 10.0, 2.0)], "s double, rd double, rf double")
    got = df.select(M.parity_forward("s", "rd", "rf", 63, 90).alias("f")).first().f
    assert abs(got - 5.0 * 1.1 ** 0.25 / (1 + 0.02 * 90 / 360)) < 1e-12


def test_call_trigger_is_strict(spark):
    from tempora.plans.reports import forward_vs_call
    row = dict(data=dt.date(2020, 1, 1), ptax=5.0, cdi=10.0, vol_21d_anual_pct=15.0,
               regime_vol="1-Baixa", fwd_teorico_90d=5.1, ptax_em_90d=5.1)
    df = spark.createDataFrame([row])
    r = forward_vs_call(df).first()
    assert r.pct_call_acionada == 0.0 and r.cobertura_media_quando_acionada_pct is None


def test_vol_min_periods(spark):
    w = gold.wide_fact(_silver(spark, [1.0 + (i % 5) / 10 for i in range(40)]), block_rows=None,
                       vol_min_periods=21).orderBy("data").collect()
    assert all(r.vol_21d_anual_pct is None for r in w[:21])
    assert all(r.vol_21d_anual_pct is not None for r in w[21:])


def test_quantile_exact_equals_approx_on_small_groups(spark):
    import random
    random.seed(3)
    df = spark.createDataFrame([(random.randint(0, 2), random.uniform(0, 100)) for _ in range(900)], "g int, x double")
    got = df.groupBy("g").agg(M.quantile("x", [1 / 3, 2 / 3, 0.95]).alias("a"),
                              M.quantile("x", [1 / 3, 2 / 3, 0.95], exact=True).alias("e")).collect()
    assert all(list(r.a) == list(r.e) for r in got)


def test_round_exact_resolves_decimal_ties_half_up(spark):
    df = spark.createDataFrame([(1.000050,), (2.123450,), (0.000049,), (None,)], "x double")
    got = [r.y for r in df.select(M.round_exact("x", 4).alias("y")).collect()]
    assert got == [1.0001, 2.1235, 0.0, None]


def test_range_partitions_from_plan_size(spark):
    from tempora.operators.windows import range_partitions
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = spark.range(10)
    assert range_partitions(small) == base
    assert range_partitions(small, target_bytes=1) >= base
