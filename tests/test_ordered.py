"""As-of joins, running values and sliding frames against brute force."""
import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tempora.operators.ordered import asof_join, ordered_parts, running_last, running_sums
from tempora.operators.sliding import sliding_extremes, sliding_mean, time_frame_moments
from tempora.operators.windows import WindowPlan

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
T0 = dt.datetime(2024, 1, 1)


def brute_asof(left, right, strict=False, tolerance=None):
    out = []
    for i, k, t in left:
        best = None
        for rk, rt, v in right:
            if k is None or rk is None or rk != k or t is None or rt is None or not (rt < t if strict else rt <= t):
                continue
            if best is None or (rt, v) > best:
                best = (rt, v)
        if best and tolerance is not None and best[0] < t - tolerance:
            best = None
        out.append((i, k, t, best and best[0], best and best[1]))
    return sorted(out, key=str)


def spark_asof(spark, left, right, **how):
    a = spark.createDataFrame(left, "i int, k int, t int")
    b = spark.createDataFrame(right, "k int, rt int, v int")
    j = asof_join(a, b, ["k"], "t", "rt", {"rt": "at", "v": "value"}, ties=["v"], **how)
    return sorted(map(tuple, j.select("i", "k", "t", "at", "value").collect()), key=str)


CASES = st.tuples(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.integers(0, 12))), max_size=30),
                  st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.integers(0, 12)), st.integers(0, 3)), max_size=30))


@SLOW
@given(CASES, st.booleans(), st.one_of(st.none(), st.integers(0, 5)))
def test_asof_join(spark, case, strict, tolerance):
    left = [(i, k, t) for i, (k, t) in enumerate(case[0])]
    got = spark_asof(spark, left, case[1], strict=strict, tolerance=None if tolerance is None else F.lit(tolerance), partitions=5)
    assert got == brute_asof(left, case[1], strict, tolerance)


def test_asof_hot_key_is_split(spark):
    left = [(i, 0 if i % 3 else 1, i) for i in range(600)]
    right = [(0, 5, 1), (1, 7, 2), (0, 300, 3)]
    assert spark_asof(spark, left, right, partitions=16) == brute_asof(left, right)
    parts = ordered_parts(spark.createDataFrame(left, "i int, k int, t int"), ["k"], ["t"], 16)
    assert parts.filter("k = 0").select("_part").distinct().count() > 5


def test_asof_clashing_names_and_empty_sides(spark):
    a = spark.createDataFrame([(1, 1, 5, "x")], "k int, _time int, t int, _right string")
    b = spark.createDataFrame([], "k int, rt int, v int")
    row = asof_join(a, b, ["k"], "t", "rt", {"v": "value"}).collect()
    assert [tuple(r) for r in row] == [(1, 1, 5, "x", None)]
    assert asof_join(a.limit(0), b, ["k"], "t", "rt", {"v": "value"}).count() == 0


def test_running_values_across_parts(spark):
    rows = [(i % 2, i, i if i % 5 == 0 else None, Decimal(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t int, v int, d decimal(18,2)")
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    parts = ordered_parts(df, ["k"], ["t"], 9)
    want = df.select("k", "t", F.last("v", True).over(w).alias("v"), F.sum("d").over(w).alias("s"))
    got = running_last(parts, ["k"], ["t"], ["v"]).select("k", "t", "v").join(
        running_sums(parts, ["k"], ["t"], {"d": "s"}).select("k", "t", "s"), ["k", "t"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("block_rows", [None, 40])
@pytest.mark.parametrize("frame", [(-6, 0), (-3, -1), (0, 0), (1, 5), (2, 4), (0, 3)])
def test_extremes_equal_the_sliding_frame(spark, block_rows, frame):
    rows = [(k, t, None if (t * 7 + k) % 11 == 0 else float((t * 37 + k * 13) % 29)) for k in (0, 1) for t in range(60 + 23 * k)] + [(2, 0, 4.0)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    plan = WindowPlan(df, ["k"], ["t"], block_rows, pre=6, post=5)
    x = plan.df if plan.blocked else plan.df.withColumn("_rn", F.row_number().over(plan.base) - 1)
    x = sliding_extremes(plan, x, "v", *frame, "_rn", low="lo", high="hi")
    got = plan.finish(x).select("k", "t", "lo", "hi")
    w = Window.partitionBy("k").orderBy("t").rowsBetween(*frame)
    want = df.select("k", "t", F.min("v").over(w).alias("lo"), F.max("v").over(w).alias("hi"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_mean_from_prefix_sums(spark):
    rows = [(t, None if t % 9 == 0 else Decimal(t * t % 97) / 4) for t in range(90)]
    df = spark.createDataFrame(rows, "t int, v decimal(18,2)")
    plan = WindowPlan(df, [], ["t"], 30, pre=7, post=0)
    got = plan.finish(sliding_mean(plan, plan.df, "v", 7, "m")).select("t", F.round("m", 6).cast("double").alias("m"))
    want = df.select("t", F.round(F.avg("v").over(Window.orderBy("t").rowsBetween(-6, 0)), 6).cast("double").alias("m"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_time_frames(spark):
    rows = [(None if i % 7 == 0 else i % 3, T0 + dt.timedelta(hours=(i * i) % 400), None if i % 10 == 3 else (i * 31 % 100) / 4 - 9) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t timestamp, v double")
    got = {(r.k, r.t): r for r in time_frame_moments(df, ["k"], "t", "v", "2 DAYS", 2, partitions=6).collect()}
    assert len(got) == len({(k, t) for k, t, _ in rows})
    for (k, t), r in got.items():
        x = [v for kk, tt, v in rows if kk == k and t - dt.timedelta(days=2) <= tt <= t and v is not None]
        assert r.n == len(x) and r.soma == pytest.approx(sum(x), abs=1e-9)
        assert r.media is None if not x else r.media == pytest.approx(sum(x) / len(x), abs=1e-9)
        if len(x) > 1:
            m = sum(x) / len(x)
            assert r.desvio == pytest.approx((sum((y - m) ** 2 for y in x) / (len(x) - 1)) ** 0.5, abs=1e-7)
        else:
            assert r.desvio is None


def test_constant_values_far_from_zero_have_no_deviation(spark):
    df = spark.createDataFrame([(1, T0 + dt.timedelta(hours=i), 987654321.25) for i in range(30)], "k int, t timestamp, v double")
    assert {r.desvio for r in time_frame_moments(df, ["k"], "t", "v", "1 DAY", 2).collect()} == {None, 0.0}
