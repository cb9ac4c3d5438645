"""Stored states that merge, and published versions, against plain Python."""
import datetime as dt
import os
import statistics

import pytest
from pyspark.sql import functions as F

from tempora.operators import states as S
from tempora.sources.publish import publish


def test_merged_sketches_hold_their_rank_error(spark):
    df = spark.range(200_000).select((F.col("id") % 7).alias("k"), (F.col("id") % 50).alias("mes"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("v"))
    cuts = S.merged_cuts(S.quantile_sketches(df, ["k", "mes"], "v"), ["k"], [0.1, 0.5, 0.99]).collect()
    assert len(cuts) == 7 and sum(r.n for r in cuts) == 200_000
    by = {r.k: sorted(x.v for x in df.filter(F.col("k") == r.k).select("v").collect()) for r in cuts[:2]}
    for r in cuts[:2]:
        for f, c in zip((0.1, 0.5, 0.99), r.cuts):
            assert abs(sum(x <= c for x in by[r.k]) / r.n - f) < 0.001


def test_sketches_leave_out_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k string, v double")
    assert [tuple(r) for r in S.merged_cuts(S.quantile_sketches(df, ["k"], "v"), ["k"], [0.5]).collect()] == [("a", 1, [1.0])]


def test_bitmaps_count_exactly(spark):
    rows = [(m, n) for m in range(4) for n in [0, 1, 1, 32_767, 32_768, 65_536 + m, 5 * m]] + [(1, None), (None, 3)]
    df = spark.createDataFrame(rows, "m int, n long")
    stored = S.distinct_bitmaps(df, ["m"], F.col("n"))
    got = {r.m: r.distintos for r in S.merged_distinct(stored, ["m"]).collect()}
    assert got == {m: len({n for k, n in rows if k == m and n is not None}) for m in (None, 0, 1, 2, 3)}
    (total,) = S.merged_distinct(stored, []).collect()
    assert total.distintos == len({n for _, n in rows if n is not None})


def test_bitmaps_refuse_what_they_cannot_hold(spark):
    with pytest.raises(Exception, match="from 0 on"):
        S.distinct_bitmaps(spark.createDataFrame([(1, -1)], "m int, n long"), ["m"], F.col("n")).collect()
    pairs = spark.createDataFrame([(1, 2), (1, None), (2, 9)], "a long, b int")
    with pytest.raises(Exception, match="outside"):
        pairs.select(S.paired("a", "b", 8)).collect()
    assert [r[0] for r in pairs.filter("a = 1").select(S.paired("a", "b", 8)).collect()] == [10, None]


def test_moments_merge_to_the_whole(spark):
    rows = [(k, d, 1e6 + (d * d * 7 + i * 3) % 11) for k in ("a", None) for d in range(9) for i in range(d)] + [("a", 3, None), ("b", 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, d int, v double")
    got = {r.k: r for r in S.merge_moments(S.moment_states(df, ["k", "d"], "v"), ["k"]).select("k", "n", "mean", S.deviation().alias("sd")).collect()}
    for k in ("a", None):
        x = [v for kk, _, v in rows if kk == k and v is not None]
        assert got[k].n == len(x) and got[k].mean == pytest.approx(statistics.mean(x), rel=1e-12)
        assert got[k].sd == pytest.approx(statistics.stdev(x), rel=1e-9)
    assert got["b"].n == 1 and got["b"].sd is None
    (whole,) = S.merge_moments(S.moment_states(df, ["k", "d"], "v"), []).collect()
    assert whole.n == sum(v is not None for *_, v in rows)


def _versions(root):
    return sorted(os.listdir(root))


def test_a_failed_run_leaves_the_table_readable(spark, tmp_path):
    root, name = str(tmp_path / "t"), "default.versioned"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert publish(spark, name, spark.range(5).toDF("a"), root).count() == 5
    spark.sql(f"COMMENT ON TABLE {name} IS 'kept'")
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("half way")).cast("bigint")).otherwise(F.col("id")).alias("a"))
    with pytest.raises(Exception, match="half way"):
        publish(spark, name, broken, root)
    assert sorted(r.a for r in spark.table(name).collect()) == [0, 1, 2, 3, 4]
    assert _versions(root) == ["v00000001", "v00000002"]            # what the failed run left
    assert publish(spark, name, spark.range(7).toDF("a"), root).count() == 7
    assert _versions(root) == ["v00000001", "v00000003"]            # it is gone, one older version stays
    publish(spark, name, spark.range(8).toDF("a"), root)
    assert _versions(root) == ["v00000003", "v00000004"] and spark.table(name).count() == 8
    assert "kept" in str(spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect())
    spark.sql(f"DROP TABLE {name}")


def test_a_table_replaced_from_itself_and_a_changed_schema(spark, tmp_path):
    root, name = str(tmp_path / "t"), "default.versioned2"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    publish(spark, name, spark.range(5).toDF("a"), root)
    publish(spark, name, spark.table(name).filter("a > 2"), root)
    assert spark.table(name).count() == 2
    publish(spark, name, spark.createDataFrame([("x", dt.date(2020, 1, 1))], "b string, d date"), root)
    assert [tuple(r) for r in spark.table(name).collect()] == [("x", dt.date(2020, 1, 1))]
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("rule", ["id > 10", "1 = 0"])
def test_an_empty_table_is_published(spark, tmp_path, rule):
    name = "default.versioned3"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert publish(spark, name, spark.range(5).filter(rule), str(tmp_path / "t")).count() == 0
    spark.sql(f"DROP TABLE {name}")
