"""Sliding frames in linear time: extremes from block ends, moments from exact
prefix sums.

A sliding ``min``/``max`` over n rows rescans up to n rows for every row. Here
rows are cut into blocks of the frame's length; a running extreme from the
start of each block and one from its end are both linear, and a frame, which
touches two blocks at most, is the better of the two values at its ends.

Sums, means and deviations of a frame are differences of two prefix sums in
DECIMAL, which are exact whatever the frame's length. A frame by rows looks
its first sum up with ``lag``; a frame by time with an as-of join at the
frame's start (``time_frame_moments``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators.ordered import asof_join, ordered_parts, running_sums
from tempora.operators.windows import WindowPlan


def sliding_extremes(plan: WindowPlan, df: DataFrame, value: str, start: int, end: int, rows: str,
                     low: str | None = None, high: str | None = None) -> DataFrame:
    """Adds ``low`` / ``high``: min / max of ``value`` over the ROWS frame
    [start, end] (both behind or both ahead of the row, 0 allowed), NULLs
    skipped. ``rows`` is the dense row number per key that the plan's windows
    are ordered by. Frames cut short by the series' ends yield values."""
    n = end - start + 1
    if n < 1 or start < 0 < end:
        raise ValueError("the frame must lie on one side of the row")
    names = [(name, f, pick) for name, f, pick in ((low, F.min, F.least), (high, F.max, F.greatest)) if name]
    block = F.floor(F.col(rows) / n)
    df = df.withColumn("_fb", block)
    inside = Window.partitionBy(*plan.window_keys, "_fb")
    up = inside.orderBy(rows).rowsBetween(Window.unboundedPreceding, 0)
    down = inside.orderBy(F.desc(rows)).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({f"_up_{name}": f(value).over(up) for name, f, _ in names})
    df = df.withColumns({f"_dn_{name}": f(value).over(down) for name, f, _ in names})
    at = lambda c, k: c if k == 0 else F.lag(c, -k).over(plan.base) if k < 0 else F.lead(c, k).over(plan.base)
    whole = plan.base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = {}
    for name, _, pick in names:
        up_c, dn_c = F.col(f"_up_{name}"), F.col(f"_dn_{name}")
        if end <= 0:
            # the row at the frame's end; before the series' start there is only the first block
            last = at(up_c, end)
            first = at(dn_c, start) if start else F.lit(None)
            out[name] = F.when(at(F.col(rows), end).isNotNull(), pick(first, last) if start else last)
        else:
            # beyond the series' end the frame stops at its last row, which counts if it lies in a later block
            stop = F.when(F.floor(F.last(rows).over(whole) / n) > F.floor((F.col(rows) + start) / n), F.last(up_c).over(whole))
            last = F.when(at(F.col(rows), end).isNotNull(), at(up_c, end)).otherwise(stop)
            first = at(dn_c, start)
            out[name] = F.when(at(F.col(rows), start).isNotNull(), pick(first, last))
    keep = [c for c in df.columns if c != "_fb" and not c.startswith(("_up_", "_dn_"))]
    return df.withColumns(out).select(*keep, *out)


def sliding_mean(plan: WindowPlan, df: DataFrame, value: str, rows_back: int, name: str) -> DataFrame:
    """Adds ``name``: the exact mean of a DECIMAL column over this row and the
    ``rows_back - 1`` before it (NULLs skipped), as a difference of running sums."""
    run = plan.base.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"_ps": F.sum(value).over(run), "_pn": F.count(value).over(run)})
    less = lambda c: F.col(c) - F.coalesce(F.lag(c, rows_back).over(plan.base), F.lit(0))
    df = df.withColumns({"_ps_f": less("_ps"), "_pn_f": less("_pn")})
    return df.withColumn(name, F.when(F.col("_pn_f") > 0, F.col("_ps_f") / F.col("_pn_f").cast("decimal(18,0)"))).drop("_ps", "_pn", "_ps_f", "_pn_f")


def units(col: str | Column, scale: int) -> Column:
    """A value with ``scale`` decimals as a whole number of its last places."""
    c = F.col(col) if isinstance(col, str) else col
    return F.rint(c.cast("double") * 10 ** scale).cast("decimal(20,0)")


def moments(n: Column, s1: Column, s2: Column, scale: int) -> dict[str, Column]:
    """mean and sample standard deviation from count, sum and sum of squares in
    whole units: the numerator n s2 - s1^2 is exact, and never negative."""
    one = 10.0 ** scale
    wide = "decimal(38,0)"
    num = n.cast("decimal(18,0)") * s2.cast(wide) - s1.cast("decimal(19,0)") * s1.cast("decimal(19,0)")
    return {"mean": F.when(n > 0, s1.cast("double") / n / one),
            "stddev": F.when(n > 1, F.sqrt(num.cast("double") / (n * (n - 1))) / one)}


def time_frame_moments(df: DataFrame, keys: Sequence[str], time: str, value: str, width: str, scale: int,
                       partitions: int | None = None) -> DataFrame:
    """Per key and distinct time t: count, sum, mean and sample deviation of
    the values in [t - width, t] (RANGE frame; rows of one time share it).

    Rows of one (key, time) are combined first; prefix sums run over these; the
    frame's first sum is the last prefix sum strictly before t - width, found
    by an as-of join of the sums with themselves."""
    keys = list(keys)
    x = units(value, scale)
    per = (df.filter(F.col(time).isNotNull()).groupBy(*keys, time)
           .agg(F.count(value).alias("_n"), F.coalesce(F.sum(x), F.lit(0)).cast("decimal(30,0)").alias("_a"),
                F.coalesce(F.sum((x * x).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("_b")))
    sums = running_sums(ordered_parts(per, keys, [time], partitions), keys, [time], {"_n": "_cn", "_a": "_ca", "_b": "_cb"})
    sums = sums.select(*keys, time, "_cn", F.col("_ca").cast("decimal(38,0)").alias("_ca"), F.col("_cb").cast("decimal(38,0)").alias("_cb"))
    from tempora.session import cut_lineage
    sums = cut_lineage(sums, "prefix-sums")
    # a NULL key is a key of its own here
    null = [F.col(k).isNull().alias(f"_null_{k}") for k in keys]
    filled = [F.coalesce(F.col(k), F.lit(0).cast(sums.schema[k].dataType)).alias(f"_k_{k}") for k in keys]
    on = [c for k in keys for c in (f"_k_{k}", f"_null_{k}")]
    probe = sums.withColumn("_from", F.col(time) - F.expr(f"INTERVAL {width}")).select("*", *filled, *null)
    base = sums.select(F.col(time).alias("_t"), *[F.col(c).alias(f"{c}0") for c in ("_cn", "_ca", "_cb")], *filled, *null)
    j = asof_join(probe, base, on, "_from", "_t", {f"{c}0": f"{c}1" for c in ("_cn", "_ca", "_cb")}, strict=True, partitions=partitions)
    less = lambda c: F.col(c) - F.coalesce(F.col(f"{c}1"), F.lit(0))
    j = j.withColumns({"_n": less("_cn"), "_s1": less("_ca"), "_s2": less("_cb")})
    m = moments(F.col("_n"), F.col("_s1"), F.col("_s2"), scale)
    return j.select(*keys, time, F.col("_n").alias("n"), (F.col("_s1").cast("double") / 10.0 ** scale).alias("soma"),
                    m["mean"].alias("media"), m["stddev"].alias("desvio"))
