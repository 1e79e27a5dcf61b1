"""VWAP and RSI of a day or of the last rows only.

A trailing frame's sum is the difference of two running sums, the one at the
row and the one ``lookback`` rows before, so no frame is gone through again.
VWAP's sums are integers, so their difference is exact.  RSI's sums fade:
the earlier one is faded by as many rows before it is taken off.  Weights restart
every ``rsi_block_rows`` rows as in ``operators.enrich``; there, the rows
before the restart are added by their faded total.  Whether a frame has
a gain or a loss at all is counted, so that a rest of rounding is no loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickwise.functions import indicators as ind
from tickwise.functions.numeric import safe_div
from tickwise.operators.enrich import ORDER_COLS, rsi_carry, symbol_window, usable


def with_vwap(ticks: DataFrame, lookback: int | None = None, reset: str | None = None, key: str = "symbol",
              price_scale: int = 2) -> DataFrame:
    """Add ``vwap``: cumulative, starting anew with every value of ``reset`` (a day's column),
    over the last ``lookback`` rows only, or both.  Null on rows without a volume."""
    if lookback is not None and lookback < 1:
        raise ValueError("lookback must be at least 1")
    w = Window.partitionBy(key, *([reset] if reset else [])).orderBy(*ORDER_COLS)
    run = ind.running(w)
    pv, v = ind.vwap_terms("close", "volume", price_scale)
    x = usable(ticks, key).select("*", F.sum(pv).over(run).alias("_pv"), F.sum(v).over(run).alias("_v"))
    sums = [F.col("_pv"), F.col("_v")]
    if lookback is not None:
        x = x.select("*", *[F.lag(c, lookback).over(w).alias(f"{c}0") for c in ("_pv", "_v")])
        sums = [F.col(c) - F.coalesce(F.col(f"{c}0"), F.lit(0).cast(x.schema[c].dataType)) for c in ("_pv", "_v")]
    units = F.when(F.col("volume").isNotNull(), safe_div(*sums))
    return x.withColumn("vwap", ind.units_to_2dp(units, price_scale)).drop("_pv", "_v", "_pv0", "_v0")


def with_rsi(ticks: DataFrame, lookback: int, periods: int = 14, key: str = "symbol", block: int | None = None) -> DataFrame:
    """Add ``rsi_14`` as a series of the last ``lookback`` rows gives it (their first row has no
    difference)."""
    if lookback < 1:
        raise ValueError("lookback must be at least 1")
    block = block or ind.rsi_block_rows(periods)
    w = symbol_window(key)
    run = ind.running(w)
    g, l = ind.gain_loss("close", w)
    x = usable(ticks, key).select("*", (F.row_number().over(w) - 1).alias("_k"), g.alias("_g"), l.alias("_l"))
    x = (x.withColumn("_r", F.floor(F.col("_k") / block).cast("long"))
          .withColumn("_wt", F.pow(F.lit(ind.rsi_growth(periods)), (F.col("_k") - F.col("_r") * block).cast("double"))))
    inner = ind.running(Window.partitionBy(key, "_r").orderBy(*ORDER_COLS))
    x = x.select("*", F.sum(F.col("_g") * F.col("_wt")).over(inner).alias("_gi"),
                 F.sum(F.col("_l") * F.col("_wt")).over(inner).alias("_li"),
                 *[F.count(F.when(c, F.lit(1))).over(run).alias(n) for n, c in
                   (("_nd", F.col("_g").isNotNull()), ("_ng", F.col("_g") > 0), ("_nl", F.col("_l") > 0))])
    total = F.when((F.col("_k") + 1) % block == 0, F.struct("_r", F.col("_gi").alias("_g"), F.col("_li").alias("_l")))
    before = Window.partitionBy(key).orderBy("_r").rangeBetween(-ind.rsi_carry_lags(periods, block), -1)
    x = x.withColumn("_t", total).withColumn("_t", F.collect_list("_t").over(before))
    zero = F.lit(0.0)
    cg, cl = rsi_carry(F.col("_t"), ind.rsi_decay(periods, block))
    # sums in units of the row itself
    x = (x.withColumn("_gs", (cg + F.coalesce("_gi", zero)) / F.col("_wt"))
          .withColumn("_ls", (cl + F.coalesce("_li", zero)) / F.col("_wt")))
    # the frame's differences are those of its rows but the first
    back = lookback - 1
    names = ("_gs", "_ls", "_nd", "_ng", "_nl")
    x = x.select("*", *[F.lag(c, back).over(w).alias(f"{c}0") if back else F.col(c).alias(f"{c}0") for c in names])
    fade = F.lit((1.0 / ind.rsi_growth(periods)) ** back)
    here = {c: F.col(c) - F.coalesce(F.col(f"{c}0"), F.lit(0)) for c in names[2:]}
    gain, loss = (F.when(here[n] > 0, F.greatest(F.col(c) - fade * F.coalesce(F.col(f"{c}0"), zero), zero)).otherwise(zero)
                  for c, n in (("_gs", "_ng"), ("_ls", "_nl")))
    return (x.withColumn("rsi_14", ind.rsi_from_sums(gain, loss, here["_nd"], periods))
             .drop("_k", "_g", "_l", "_r", "_wt", "_gi", "_li", "_t", *names, *[f"{c}0" for c in names]))
