"""Stored states that merge: quantile sketches, bitmaps of distinct keys, and
moments. Each is aggregated once per key and period, written, and merged for
any later question without reading the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a KLL sketch of this size has a rank error of about 0.0004
SKETCH_K = 16_384


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """(keys, sketch, n): a KLL sketch of the non-NULL values of each key."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys)
            .agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"), F.count("*").alias("n")))


def merged_cuts(sketches: DataFrame, keys: Sequence[str], fractions: Sequence[float], k: int = SKETCH_K) -> DataFrame:
    """(keys, n, cuts): the values at the fractions of all values of the merged sketches."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("_s"), F.sum("n").alias("n"))
    return merged.select(*keys, "n", F.array(*[F.kll_sketch_get_quantile_double("_s", F.lit(float(f))) for f in fractions]).alias("cuts"))


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], number: Column) -> DataFrame:
    """(keys, bucket, bits): which whole numbers from 0 on occur, 32768 to a
    bitmap. NULL numbers are left out; a negative one raises. Meant for dense
    keys: a bitmap has 4 KB before it is compressed, however few bits are set."""
    checked = F.when(number < 0, F.raise_error(F.lit("a bitmap holds numbers from 0 on")).cast("bigint")).otherwise(number.cast("bigint")) + 1
    rows = df.filter(number.isNotNull()).select(*keys, checked.alias("_n"))
    return (rows.groupBy(*keys, F.bitmap_bucket_number("_n").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits")))


def merged_distinct(bitmaps: DataFrame, keys: Sequence[str], name: str = "distintos") -> DataFrame:
    """(keys, name): exact number of distinct numbers over all bitmaps of a key."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("_b"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("_b")).alias(name))


def paired(high: str, low: str, places: int) -> Column:
    """Two whole numbers as one, the lower within 0 .. places - 1 (else an error); NULL if either is."""
    lo = F.col(low)
    fits = F.when(lo.between(0, places - 1), lo).otherwise(F.when(lo.isNotNull(), F.raise_error(F.lit(f"{low} outside 0 .. {places - 1}")).cast("bigint")))
    return F.col(high).cast("bigint") * places + fits


def moment_states(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n, mean, m2): count, mean and sum of squared deviations of the non-NULL values."""
    return (df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("_v"))
            .select(*keys, "n", "mean", (F.col("_v") * F.col("n")).alias("m2")).filter("n > 0"))


def merge_moments(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of each key as one, by the rule for parallel variances: the
    squared deviations inside the states and those between their means."""
    total = states.groupBy(*[F.col(c).alias(f"_of_{c}") for c in keys]).agg(
        F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    within = F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2
    return (states.join(total, on).groupBy(*keys, F.col("_n").alias("n"), F.col("_mean").alias("_m")).agg(F.sum(within).alias("m2"))
            .select(*keys, "n", F.col("_m").alias("mean"), "m2"))


def deviation(n: str = "n", m2: str = "m2") -> Column:
    """Sample standard deviation of a state."""
    return F.when(F.col(n) > 1, F.sqrt(F.col(m2) / (F.col(n) - 1)))
