"""Pure Column builders for series metrics.

All stay inside whole-stage codegen: built-in functions only. Ratios use
``try_divide`` so a zero divisor gives NULL under ANSI mode instead of an
error; ``ln`` of a non-positive number is NULL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SQRT_252 = math.sqrt(252.0)


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_exact(x, digits: int, scale: int = 6) -> Column:
    """Round a DOUBLE known to carry ``scale`` decimals (e.g. a parsed
    DECIMAL(18,6) value) half-up to ``digits`` through DECIMAL arithmetic, so
    a tie like ...5 at the cut is resolved on the decimal value, not on its
    binary approximation."""
    return F.round(c(x).cast(f"decimal(38,{scale})"), digits).cast("double")


def ratio(a, b) -> Column:
    return F.try_divide(c(a), c(b))


def log_return(x, prev) -> Column:
    """ln(x / prev); NULL when either side is NULL or the ratio is <= 0."""
    r = ratio(x, prev)
    return F.when(r > 0, F.ln(r))


def pct_change(x, prev) -> Column:
    """(x / prev - 1) * 100."""
    return (ratio(x, prev) - 1) * 100


def annualised_vol(stddev_col, periods: float = 252.0) -> Column:
    """sample stddev of returns * sqrt(periods) * 100 (percent a year)."""
    return c(stddev_col) * math.sqrt(periods) * 100


def range_position(x, lo, hi) -> Column:
    """(x - lo) / (hi - lo); NULL when the range is empty (hi == lo)."""
    return ratio(c(x) - c(lo), F.nullif(c(hi) - c(lo), F.lit(0.0)))


def spread(a, b) -> Column:
    """a - b (rate differential, percentage points)."""
    return c(a) - c(b)


def band(x, lo: float = 0.25, hi: float = 0.75, labels: Sequence[str] = ("low", "mid", "high")) -> Column:
    """Fixed band, both edges inclusive: x <= lo -> low, x >= hi -> high,
    else mid; NULL stays NULL (C15)."""
    x = c(x)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x <= lo, labels[0]).when(x >= hi, labels[2]).otherwise(labels[1]))


def cut_buckets(x, cuts: Sequence, labels: Sequence[str]) -> Column:
    """Ordered cut points: x <= cuts[0] -> labels[0], ..., else labels[-1];
    NULL stays NULL (C14). ``cuts`` may be Columns (from a one-row frame)."""
    x = c(x)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        expr = expr.when(x <= (cut if isinstance(cut, Column) else F.lit(cut)), label)
    return expr.otherwise(labels[len(cuts)])


def parity_forward(spot, rate_dom_pct, rate_for_pct, business_days: int, calendar_days: int) -> Column:
    """Interest-parity forward: spot * (1 + rd/100)^(du/252) / (1 + rf/100 * dc/360)."""
    return (c(spot) * F.pow(1 + c(rate_dom_pct) / 100, F.lit(business_days / 252))
            / (1 + c(rate_for_pct) / 100 * calendar_days / 360))


def gated(cond: Column, value: Column) -> Column:
    """NULL unless ``cond`` holds (P16, no otherwise branch)."""
    return F.when(cond, value)


def safe_corr(a, b) -> Column:
    """Pearson correlation that is NULL (not an error, not NaN) for constant or
    single-pair input: covar_samp / (stddev_samp(a') * stddev_samp(b')) with
    a', b' set to NULL unless both sides are present (A11, G2)."""
    a, b = c(a), c(b)
    both = a.isNotNull() & b.isNotNull()
    a2, b2 = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(a2, b2), F.stddev_samp(a2) * F.stddev_samp(b2))


def pct_true(cond: Column) -> Column:
    """100 * AVG(CASE WHEN cond THEN 1 ELSE 0 END): NULL conditions count as 0
    and stay in the denominator (A6)."""
    return 100 * F.avg(F.when(cond, 1).otherwise(0))


def quantile(x: str, q, exact: bool = False, accuracy: int = 10000) -> Column:
    """Percentile of column ``x``: ``percentile_approx`` (bounded memory; exact
    while a group holds fewer than ``accuracy`` rows) or, with ``exact``,
    ``percentile_disc`` (keeps every distinct value of the group: only for
    groups with a proven size bound). A list ``q`` gives an array."""
    qs = list(q) if isinstance(q, (list, tuple)) else [q]
    if exact:
        exprs = [F.expr(f"percentile_disc({float(p)!r}) WITHIN GROUP (ORDER BY `{x}`)") for p in qs]
        return F.array(*exprs) if isinstance(q, (list, tuple)) else exprs[0]
    if isinstance(q, (list, tuple)):
        return F.percentile_approx(F.col(x), [float(p) for p in qs], accuracy)
    return F.percentile_approx(F.col(x), float(q), accuracy)
