"""Running values and as-of joins over keyed, ordered rows of any size.

``ordered_parts`` sorts rows once by key and order with a range exchange and
writes them with the number of their part, so a hot key, or a burst inside one
key, lies in as many parts as its rows need. A running value is then three
steps, none of them a window over a whole key:

1. a summary row per (key, part): the part's last value, or its sum;
2. a window over the summary (at most #keys + #parts rows) carries it into the
   later parts of the key;
3. a window inside (key, part) finishes it, starting from the carried value.

``asof_join`` unions two event tables, orders them by key and time, and
carries the last right-hand row; the left-hand rows take it, or NULL beyond a
tolerance. The number of series is not limited and no list of them is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators.windows import join_null_safe, range_partitions
from tempora.session import cut_lineage

PART = "_part"


def ordered_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` with its part number: parts are ranges of ``keys + order``, and
    every part holds a stretch of consecutive rows. Written at once, so a
    recomputed task can never deal a row to another part."""
    s = (df.repartitionByRange(partitions or range_partitions(df), *[F.col(c) for c in [*keys, *order]])
         .withColumn(PART, F.spark_partition_id()))
    return cut_lineage(s, "ordered")


def _before(keys: Sequence[str]):
    return (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def _inside(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def running_last(parts: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each column becomes its last non-NULL value at or before the row, within the key."""
    at = F.struct(*order)
    per = parts.groupBy(*keys, PART).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_l_{c}") for c in columns])
    carry = per.select(*keys, PART, *[F.last(f"_l_{c}", ignorenulls=True).over(_before(keys)).alias(f"_c_{c}") for c in columns])
    w = _inside(keys, order)
    out = join_null_safe(parts, carry, [*keys, PART])
    return out.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_c_{c}")) for c in columns}).drop(*[f"_c_{c}" for c in columns])


def running_sums(parts: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Adds ``columns[c]``: the sum of ``c`` from the key's first row to this
    one. Exact for DECIMAL and integer columns; NULL counts as nothing."""
    per = parts.groupBy(*keys, PART).agg(*[F.sum(c).alias(f"_s_{c}") for c in columns])
    carry = per.select(*keys, PART, *[F.sum(f"_s_{c}").over(_before(keys)).alias(f"_c_{c}") for c in columns])
    w = _inside(keys, order)
    out = join_null_safe(parts, carry, [*keys, PART])
    zero = F.lit(0)
    return out.withColumns({name: F.coalesce(F.col(f"_c_{c}"), zero) + F.coalesce(F.sum(c).over(w), zero)
                            for c, name in columns.items()}).drop(*[f"_c_{c}" for c in columns])


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: dict[str, str], tolerance: Column | None = None, strict: bool = False,
              ties: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Every left row with the right row of the same key that is last at or
    before its time (before it, if ``strict``).

    ``values``: right column -> name in the result. Of right rows with one key
    and time the largest by ``ties`` (then by all value columns) counts.
    ``tolerance`` (an interval): an older right row counts as none. A NULL key
    or time equals nothing, as in SQL: such left rows get NULLs and such right
    rows are left out, before anything is shuffled."""
    keys = list(keys)
    known = lambda time: F.greatest(*[F.col(k).isNull().cast("int") for k in [*keys, time]], F.lit(0)) == 0
    picked = [F.struct(F.col(right_time).alias("_at"), *[F.col(c).alias(n) for c, n in values.items()])]
    # of one (key, time) only the largest row can count; combined map-side
    rights = (right.filter(known(right_time))
              .groupBy(*keys, F.col(right_time).alias("_time"))
              .agg(F.max_by(picked[0], F.struct(*[F.col(c) for c in [*ties, *values]])).alias("_right")))
    lefts = left.filter(known(left_time))
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    both = (lefts.select(*keys, F.col(left_time).alias("_time"), F.lit(0 if strict else 1).alias("_side"), row.alias("_left"))
            .unionByName(rights.select(*keys, "_time", F.lit(1 if strict else 0).alias("_side"), "_right"), allowMissingColumns=True)
            # left rows of one key and time, in any order, may part
            .withColumn("_deal", F.xxhash64("_left")))
    order = ["_time", "_side", "_deal"]
    found = running_last(ordered_parts(both, keys, order, partitions), keys, order, ["_right"]).filter("_left is not null")
    near = F.lit(True) if tolerance is None else F.col("_right._at") >= F.col("_time") - tolerance
    hit = F.when(near, F.col("_right"))
    out = found.select("_left.*", *[hit[n].alias(n) for n in values.values()])
    kinds = {n: right.schema[c].dataType for c, n in values.items()}
    rest = left.filter(~known(left_time)).select("*", *[F.lit(None).cast(kinds[n]).alias(n) for n in values.values()])
    return out.unionByName(rest)
