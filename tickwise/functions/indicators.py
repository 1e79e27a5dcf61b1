"""Indicator column builders over an ordered per-symbol window.

Each builder takes the ordered window ``w`` (partition + order, no frame)
and returns a Column.  All indicators of a table share one ``w`` so the
plan has one exchange and one sort for the whole enrichment.

With ``price_scale`` set, prices are summed as integer minor units, so
moving averages, volatility and VWAP are exact and do not depend on the
order in which an engine adds the frame up.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, WindowSpec, Window, functions as F

from tickwise.functions.numeric import np_round, safe_div, to_cents


@dataclass(frozen=True)
class CrashRule:
    """Crash flag: price drop, volume surge and volatility all past limits."""
    pct_below: float = -2.0
    volume_trend_above: float = 2.0
    volatility_above: float = 1.5


def rows_frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), Window.currentRow)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def units_to_2dp(units: Column, price_scale: int) -> Column:
    """A mean in minor units -> price rounded to 2 dp (one rounding step)."""
    if price_scale == 2:
        return F.rint(units) / F.lit(100.0)
    return np_round(units / F.lit(float(10 ** price_scale)), 2)


def moving_avg(close: str, w: WindowSpec, n: int, price_scale: int | None = 2) -> Column:
    """Mean of the last ``n`` rows (at least one), rounded to 2 dp."""
    f = rows_frame(w, n)
    if price_scale is None:
        return np_round(F.avg(close).over(f), 2)
    c = to_cents(close, price_scale)
    return units_to_2dp(safe_div(F.sum(c).over(f), F.count(c).over(f)), price_scale)


def volatility(close: str, w: WindowSpec, n: int = 5, price_scale: int | None = 2) -> Column:
    """Sample standard deviation of the last ``n`` closes (needs 2), 4 dp."""
    f = rows_frame(w, n)
    if price_scale is None:
        return np_round(F.stddev_samp(close).over(f), 4)
    # wide enough for the square of any 64-bit price
    c = to_cents(close, price_scale).cast("decimal(19,0)")
    k = F.count(c).over(f)
    s1 = F.sum(c).over(f).cast("decimal(19,0)")
    s2 = F.sum(c * c).over(f)
    # exact integer numerator n*sum(c^2) - sum(c)^2, then one division
    var_units = safe_div(k.cast("decimal(2,0)") * s2 - s1 * s1, k * (k - 1))
    sd = F.sqrt(var_units) / F.lit(float(10 ** price_scale))
    return F.when(k >= 2, np_round(sd, 4))


def vwap_terms(close: str, volume: str, price_scale: int | None = 2) -> tuple[Column, Column]:
    """Price*volume and volume as summed by VWAP: 38-digit integers, so that a
    long history of large volumes can't overflow; doubles without a scale."""
    if price_scale is None:
        return F.col(close) * F.col(volume), F.col(volume).cast("double")
    v = F.col(volume).cast("decimal(19,0)")
    return to_cents(close, price_scale).cast("decimal(18,0)") * v, v


def vwap(close: str, volume: str, w: WindowSpec, price_scale: int | None = 2) -> Column:
    """Cumulative sum(price*volume)/sum(volume) over the series, 2 dp; null on
    rows without a volume, which the sums leave out."""
    f = running(w)
    pv, v = vwap_terms(close, volume, price_scale)
    units = F.when(F.col(volume).isNotNull(), safe_div(F.sum(pv).over(f), F.sum(v).over(f)))
    return np_round(units, 2) if price_scale is None else units_to_2dp(units, price_scale)


def volume_trend(volume: str, w: WindowSpec, n: int = 5) -> Column:
    """volume / mean(volume over last n rows incl. current), 3 dp; null on 0."""
    f = rows_frame(w, n)
    return np_round(safe_div(F.col(volume) * F.count(volume).over(f),
                             F.sum(volume).over(f)), 3)


def price_change_pct(open_: str, close: str, price_scale: int | None = 2) -> Column:
    """(close - open) / open * 100, 2 dp; null when open is 0."""
    if price_scale is None:
        return np_round(safe_div(F.col(close) - F.col(open_), F.col(open_)) * F.lit(100.0), 2)
    o = to_cents(open_, price_scale)
    c = to_cents(close, price_scale)
    return F.rint(safe_div((c - o) * F.lit(10000), o)) / F.lit(100.0)


def crash_flag(pct: Column, vtrend: Column, vol: Column, rule: CrashRule = CrashRule()) -> Column:
    """Comparisons with a missing value count as false."""
    return F.coalesce(
        (pct < F.lit(rule.pct_below))
        & (vtrend > F.lit(rule.volume_trend_above))
        & (F.coalesce(vol, F.lit(0.0)) > F.lit(rule.volatility_above)),
        F.lit(False))


def latency_ms(process_ms: Column, produce_ms: Column) -> Column:
    """process - produce; a missing produce time counts as zero latency."""
    return (process_ms - F.coalesce(produce_ms, process_ms)).cast("long")


# ---- RSI -----------------------------------------------------------------
# Exponentially weighted gain/loss averages with bias correction
# (alpha = 1/periods, first value once ``periods`` differences exist).
# The normalising weights cancel in gain/loss, so
#   RS_t = sum_j gain_j * W^j / sum_j loss_j * W^j,  W = periods/(periods-1).
# W^j overflows for long series, so the weights restart every
# ``rsi_block_rows`` rows and block totals are carried on decayed.

def rsi_growth(periods: int) -> float:
    return periods / (periods - 1.0)


def rsi_block_rows(periods: int) -> int:
    """Rows per rebasing block: W^B stays far below the double range."""
    return int(min(2000, math.floor(600.0 / math.log(rsi_growth(periods)))))


def rsi_decay(periods: int, block: int) -> float:
    """What is left of a weight after a block."""
    return (1.0 / rsi_growth(periods)) ** block


def rsi_carry_lags(periods: int, block: int) -> int:
    """Blocks back whose decayed weight is still representable in a double."""
    per_block = block * math.log(rsi_growth(periods))
    return int(math.floor(745.0 / per_block)) + 1


def gain_loss(close: str, w: WindowSpec) -> tuple[Column, Column]:
    d = F.col(close) - F.lag(close).over(w)
    return (F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))),
            F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0))))


def rsi_from_sums(g_sum: Column, l_sum: Column, n_diffs: Column, periods: int) -> Column:
    rs = safe_div(g_sum, l_sum)
    return F.when((n_diffs >= F.lit(periods)) & (l_sum > 0),
                  np_round(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs), 2))
