"""Keyed variants: the same window metrics over many series at once.

A series per key (e.g. per user of an event stream) can be arbitrarily long
and one key can hold a large share of all rows, so these run on the
ordered-block path: dense row numbers come from range partitioning on
(key, order) -- a hot key, or a burst inside one key, is split across tasks
by its order values -- rows are copied into blocks with a halo, and every
window partition is one (key, block): at most ``block_rows`` + halo rows,
whatever the key's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions import metrics as M
from tempora.operators.sliding import sliding_extremes, sliding_mean
from tempora.operators.windows import WindowPlan


#: rows of a frame up to which its extreme is found by scanning the frame
SCANNED = 100


def rolling_metrics(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    bucket=None, block_rows: int | None = 100_000, horizon: int = 21,
                    value_scale: int | None = None) -> DataFrame:
    """Per key, in ``order``: previous-row log return, 21-row sample stddev of
    the return, 63-row mean and % deviation, 252-row min / max / position in
    range, value ``horizon`` rows ahead and the largest rise over the next
    ``horizon`` rows (NULL unless the full forward window exists).

    With ``value_scale`` (decimal places of the input) the moving mean is
    exact: a DECIMAL average rounded half-up to six decimals, so it does not
    depend on the order in which a double sum is accumulated.

    One strategy serves every key: with ``block_rows`` all keys, NULL included,
    go through ordered blocks of bounded size. The 252-row and forward extremes
    and the exact mean take linear time (see ``operators.sliding``)."""
    keys, order = list(keys), list(order)
    base = df.select(*keys, *order, F.col(value).cast("double").alias("valor"))
    if value_scale is not None:
        base = base.withColumn("_vdec", F.col("valor").cast(f"decimal(18,{int(value_scale)})"))
    plan = WindowPlan(base, keys, order, block_rows, bucket=bucket, pre=251, post=horizon)
    w, frame = plan.base, plan.frame
    x = plan.df if plan.blocked else plan.df.withColumn("_rn", F.row_number().over(w) - 1)
    x = x.withColumns({
        "ret": M.log_return("valor", F.lag("valor").over(w)),
        "valor_futuro": F.lead("valor", horizon).over(w),
    })
    x = x.withColumn("vol_21", F.stddev_samp("ret").over(frame(-20, 0)))
    if value_scale is None:
        x = x.withColumn("mm_63", F.avg("valor").over(frame(-62, 0)))
    else:
        x = sliding_mean(plan, x, "_vdec", 63, "_mean_63").withColumn("mm_63", F.round("_mean_63", 6).cast("double"))
    x = sliding_extremes(plan, x, "valor", -251, 0, "_rn", low="min_252", high="max_252")
    # a short frame is scanned faster than two more sorts take
    x = (sliding_extremes(plan, x, "valor", 1, horizon, "_rn", high="_max_fut") if horizon > SCANNED
         else x.withColumn("_max_fut", F.max("valor").over(frame(1, horizon))))
    x = plan.finish(x)
    return x.select(
        *keys, *order, "valor", "ret", "vol_21", "mm_63",
        M.pct_change("valor", "mm_63").alias("desvio_mm63_pct"),
        "min_252", "max_252",
        M.range_position("valor", "min_252", "max_252").alias("posicao_faixa_252"),
        "valor_futuro",
        M.gated(F.col("valor_futuro").isNotNull(), M.pct_change("_max_fut", "valor")).alias("maior_alta_pct"))
