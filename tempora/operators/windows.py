"""Keyed and ordered-block window execution.

``over`` evaluates a list of ROWS-frame window specs over ``keys`` /
``order``. Two physical strategies give the same rows:

* **keyed** (``block_rows=None``): ``Window.partitionBy(keys).orderBy(order)``.
  Right when every key's series fits one task -- e.g. a daily grain, where a
  key can never hold more rows than there are calendar days.
* **ordered blocks** (``block_rows=B``): for a long series with no usable key
  (or one hot key). Rows get a dense row number per key -- from bucket counts
  plus an in-bucket ``row_number`` when (key, bucket) groups are bounded, or
  from range partitioning otherwise (see ``row_numbers``); each row is copied
  into every block of ``B`` row numbers whose targets need it (a halo of
  ``pre``/``post`` rows); windows then run partitioned by ``keys + [block]``
  and each block keeps its home rows. No ``Exchange SinglePartition`` over the
  data: the only un-keyed window runs over the bucket summary (one row per
  bucket).

Running ("unbounded preceding") forward fill uses the same bucket summary:
last non-NULL value per bucket, carried across buckets by a window over the
summary, then combined with the in-bucket running value (``ffill``).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGGS = {
    "avg": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
    "first": F.first,
    "last": F.last,
}


class Win(NamedTuple):
    """One window column: ``fn`` over ``col`` on the ROWS frame
    ``[start, end]`` relative to the current row (negative = preceding).
    ``lag``/``lead`` use ``offset`` and ignore the frame."""
    name: str
    fn: str
    col: str
    start: int = 0
    end: int = 0
    offset: int = 1


def frame_factory(keys: Sequence[str], order: Sequence[str]):
    """``frame(ini, fim)`` -> keyed ROWS WindowSpec."""
    base = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)

    def frame(ini: int, fim: int):
        return base.rowsBetween(ini, fim)
    return frame


def _column(spec: Win, base) -> Column:
    if spec.fn == "lag":
        return F.lag(spec.col, spec.offset).over(base)
    if spec.fn == "lead":
        return F.lead(spec.col, spec.offset).over(base)
    agg = _AGGS[spec.fn]
    return agg(spec.col).over(base.rowsBetween(spec.start, spec.end))


def halo(specs: Sequence[Win]) -> tuple[int, int]:
    """Rows needed before / after the current row by ``specs``."""
    pre = post = 0
    for s in specs:
        if s.fn == "lag":
            pre = max(pre, s.offset)
        elif s.fn == "lead":
            post = max(post, s.offset)
        else:
            pre = max(pre, -s.start, -s.end, 0)
            post = max(post, s.end, s.start, 0)
    return pre, post


def _bucket_col(bucket) -> Column:
    return F.col(bucket) if isinstance(bucket, str) else bucket


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket=None,
                rn: str = "_rn", partitions: int | None = None) -> DataFrame:
    """Dense 0-based row number per key in ``order`` (unique within a key)
    without a window over a whole key.

    * ``bucket`` given (a coarse value monotone in ``order``, e.g. the month
      of a date, whose (key, bucket) groups have a known bound): counts per
      (key, bucket) -> running offsets over that summary -> offset +
      in-bucket ``row_number``.
    * ``bucket=None``: range partitioning on ``keys + order`` (sampled
      bounds split a hot key, or a hot stretch of one key, across tasks),
      a sort within partitions and ``monotonically_increasing_id``; ids are
      written to the checkpoint folder at once so a recomputed task can never
      renumber rows. Counts per (partition, key) -> running offsets over that
      summary (at most #keys + #partitions rows) -> offset + position.
    """
    keys = list(keys)
    if bucket is not None:
        b = df.withColumn("_bkt", _bucket_col(bucket))
        per = b.groupBy(*keys, "_bkt").agg(F.count("*").alias("_cnt"))
        w_off = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_bkt")
        per = per.withColumn("_off", F.coalesce(
            F.sum("_cnt").over(w_off.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        per = per.drop("_cnt")
        w_in = Window.partitionBy(*keys, "_bkt").orderBy(*order)
        return (join_null_safe(b, per, [*keys, "_bkt"])
                .withColumn(rn, F.col("_off") + F.row_number().over(w_in) - 1)
                .drop("_off"))
    from tempora.session import cut_lineage
    spark = df.sparkSession
    n_part = partitions or range_partitions(df)
    s = (df.repartitionByRange(n_part, *[F.col(c) for c in [*keys, *order]])
         .sortWithinPartitions(*keys, *order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = cut_lineage(s, "numbered")
    per = s.groupBy("_pid", *keys).agg(F.count("*").alias("_cnt"), F.min("_mid").alias("_first"))
    w_off = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_pid")
    per = per.withColumn("_off", F.coalesce(
        F.sum("_cnt").over(w_off.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_cnt")
    return (join_null_safe(s, per, ["_pid", *keys])
            .withColumn(rn, F.col("_off") + F.col("_mid") - F.col("_first"))
            .drop("_pid", "_mid", "_first", "_off"))


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on equal columns, NULL equal to NULL; the columns of ``on``
    come from the left side. AQE broadcasts the right side where it is small."""
    r = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    cond = [left[c].eqNullSafe(r[f"_on_{c}"]) for c in on]
    return left.join(r, cond, "inner").drop(*[f"_on_{c}" for c in on])


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def range_partitions(df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Partition count for a range shuffle: the session's shuffle partitions,
    or more when the optimizer's size estimate of ``df`` (plan statistics,
    no data read) exceeds ``target_bytes`` per partition. AQE can merge range
    partitions but never split them, so the count must be large enough."""
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - statistics unavailable: keep the session setting
        return base
    if size >= 2 ** 62:          # no estimate (the planner's "unknown" default size)
        return base
    return int(min(max(base, -(-size // target_bytes)), 100_000))


class WindowPlan:
    """One place to build window columns under either strategy.

    ``plan.df`` is the frame to add columns to, ``plan.frame(ini, fim)`` /
    ``plan.base`` give ROWS WindowSpecs, and ``plan.finish(df)`` returns the
    home rows with the original columns plus the new ones. Several dependent
    window stages (e.g. a lag, then a rolling stddev of the lagged return) can
    run inside one plan: pass ``pre``/``post`` as the *sum* of the stages'
    needs; stages share one partitioning and sort, so they add no exchange.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 block_rows: int | None = None, bucket=None, pre: int = 0, post: int = 0,
                 numbered: bool = False):
        self.keys, self.order = list(keys), list(order)
        self.columns = list(df.columns)
        self.blocked = block_rows is not None
        if not self.blocked:
            self.df = df
            self.window_keys = self.keys
            self.base = (Window.partitionBy(*self.keys) if self.keys else Window.partitionBy()) \
                .orderBy(*self.order)
            return
        B = int(block_rows)
        if B <= pre + post:
            raise ValueError("block_rows must exceed the halo (pre + post)")
        # ``numbered``: the caller already added a dense 0-based ``_rn`` per key
        numbered = df if numbered else row_numbers(df, self.keys, self.order, bucket)
        self.df = (numbered
                   .withColumn("_home", F.floor(F.col("_rn") / B))
                      .withColumn("_blk", F.explode(F.sequence(F.greatest(F.floor((F.col("_rn") - post) / B), F.lit(0)),
                                                           F.floor((F.col("_rn") + pre) / B)))))
        self.window_keys = [*self.keys, "_blk"]
        self.base = Window.partitionBy(*self.window_keys).orderBy("_rn")

    def frame(self, ini, fim):
        return self.base.rowsBetween(ini, fim)

    def finish(self, df: DataFrame) -> DataFrame:
        if not self.blocked:
            return df
        helpers = {"_rn", "_home", "_blk", "_bkt"}
        return (df.filter(F.col("_blk") == F.col("_home"))
                .select(*[c for c in df.columns if c not in helpers]))


def over(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Sequence[Win],
         block_rows: int | None = None, bucket=None) -> DataFrame:
    """Add one column per spec (all specs independent of each other)."""
    pre, post = halo(specs)
    plan = WindowPlan(df, keys, order, block_rows, bucket, pre, post)
    out = plan.df.withColumns({s.name: _column(s, plan.base) for s in specs})
    return plan.finish(out)


def ffill(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
          bucket=None, block_rows: int | None = None) -> DataFrame:
    """Replace each column by its last non-NULL value at or before the row
    (W6/J7: never a later value).

    With ``bucket`` (bounded (key, bucket) groups) or ``block_rows`` (blocks of
    dense row numbers from range partitioning): last non-NULL value per
    bucket, carried across buckets by a window over the bucket summary, then
    the in-bucket running value -- no window over a whole key."""
    keys, order = list(keys), list(order)
    if bucket is None and block_rows is None:
        w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(*order) \
            .rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    cols = df.columns
    if bucket is None:
        df = row_numbers(df, keys, order)
        bucket = F.floor(F.col("_rn") / int(block_rows))
        order = ["_rn"]
    b = df.withColumn("_bkt", _bucket_col(bucket))
    okey = F.struct(*[F.col(o) for o in order])
    per = b.groupBy(*keys, "_bkt").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(f"_last_{c}") for c in columns])
    w_carry = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_bkt") \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*keys, "_bkt", *[
        F.last(f"_last_{c}", ignorenulls=True).over(w_carry).alias(f"_carry_{c}") for c in columns])
    w_in = Window.partitionBy(*keys, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = join_null_safe(b, carry, [*keys, "_bkt"]).withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(w_in), F.col(f"_carry_{c}")) for c in columns})
    return out.select(*cols)
