"""Enrichment for hot symbols: the series of one symbol is split into
fixed-size row blocks so that no task holds a whole series.

Plan
----
1. Global row number per symbol without a per-symbol task: rows are
   counted per (symbol, minute), the counts of the earlier minutes are the
   offset of a minute, and rows are numbered inside it.  Both depend on
   the rows alone, so a recomputed partition gets the same numbers.
2. Blocks of ``block_rows`` rows per symbol.  The last ``HALO`` rows of
   each block are also sent to the next block, so every 5/20-row frame
   and the previous close are exact inside one (symbol, block) window
   group.  One hash exchange on (symbol, block).
3. Cumulative quantities cross blocks through small tables, read off the
   last rows of the blocks:
   * VWAP sums and difference counts: prefix over one row per block;
   * RSI: weights restart every ``rsi_block`` rows, and a sub-block starts
     with the decayed totals of those before it (``rsi_carry``), kept per
     block as an array that is read by position.
   They join back on (symbol, block); nothing is hinted, so their size
   decides between broadcast and shuffle.
   The rows of the blocks are written once before, so windows and sorts of
   the whole series run once, not once for the rows and once for the ends.

The result equals :func:`tickwise.operators.enrich.enrich`, bit by bit
where prices have a scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickwise.functions import indicators as ind
from tickwise.functions.numeric import np_round, safe_div
from tickwise.operators.enrich import rsi_carry, usable, with_defaults, with_flags, with_open
from tickwise.session import written

ORDER = ("event_time", "seq")
HALO = 19                      # rows of history the widest frame (20 rows) needs


def global_row_number(ticks: DataFrame, key: str = "symbol") -> DataFrame:
    """Adds ``_rn`` (1-based position in the symbol's (event_time, seq) order);
    needs a symbol and an event time."""
    r = ticks.withColumn("_m", F.date_trunc("minute", "event_time"))
    counts = r.groupBy(key, "_m").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(key, "_m", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    w = Window.partitionBy(key, "_m").orderBy(*ORDER)
    return (r.join(offs, [key, "_m"])
             .withColumn("_rn", F.col("_start") + F.row_number().over(w))
             .drop("_m", "_start"))


def blocks(ticks: DataFrame, block_rows: int, rsi_block: int, price_scale: int | None = 2,
           periods: int = 14, key: str = "symbol", open_from_close: bool = False) -> DataFrame:
    """The rows with their block and sub-block, what needs nothing from other
    blocks, and the running sums inside their own."""
    x = global_row_number(with_defaults(usable(ticks, key)), key)
    blk = F.floor((F.col("_rn") - 1) / block_rows).cast("long")
    in_halo = ((F.col("_rn") - 1) % block_rows) >= block_rows - HALO
    x = (x.withColumn("_own", blk)
          .withColumn("_g", F.explode(F.when(in_halo, F.array(blk, blk + 1)).otherwise(F.array(blk))))
          .withColumn("_halo", F.col("_g") != F.col("_own")).drop("_own"))

    w = Window.partitionBy(key, "_g").orderBy(*ORDER)
    run = ind.running(w)
    if open_from_close:
        x = with_open(x, w)
    real = ~F.col("_halo")
    d = F.col("close") - F.lag("close").over(w)
    pv, v = ind.vwap_terms("close", "volume", price_scale)
    x = x.select(
        "*",
        ind.moving_avg("close", w, 5, price_scale).alias("moving_avg_5"),
        ind.moving_avg("close", w, 20, price_scale).alias("moving_avg_20"),
        ind.volatility("close", w, 5, price_scale).alias("volatility"),
        ind.volume_trend("volume", w, 5).alias("volume_trend"),
        ind.price_change_pct("open", "close", price_scale).alias("price_change_pct"),
        F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))).alias("_gain"),
        F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0))).alias("_loss"),
        F.sum(F.when(real, pv)).over(run).alias("_cpv"),
        F.sum(F.when(real, v)).over(run).alias("_cv"),
        F.count(F.when(real & d.isNotNull(), F.lit(1))).over(run).alias("_nd"),
    ).where(real)
    # RSI within rebased sub-blocks (partitioned inside the same exchange)
    x = (x.withColumn("_r", F.floor((F.col("_rn") - 1) / rsi_block).cast("long"))
          .withColumn("_wt", F.pow(F.lit(ind.rsi_growth(periods)),
                                   ((F.col("_rn") - 1) % rsi_block).cast("double"))))
    wr = ind.running(Window.partitionBy(key, "_g", "_r").orderBy(*ORDER))
    return x.select("*", F.sum(F.col("_gain") * F.col("_wt")).over(wr).alias("_gi"),
                    F.sum(F.col("_loss") * F.col("_wt")).over(wr).alias("_li"))


def split_enrich(ticks: DataFrame, block_rows: int = 1_000_000, rsi_block: int | None = None,
                 price_scale: int | None = 2, crash: ind.CrashRule = ind.CrashRule(),
                 periods: int = 14, key: str = "symbol", open_from_close: bool = False) -> DataFrame:
    rsi_block = rsi_block or ind.rsi_block_rows(periods)
    block_rows = -(-max(block_rows, HALO + 1) // rsi_block) * rsi_block
    per_block = block_rows // rsi_block
    # written once: the carries below are read off the last rows, and the rows are read again to take them
    x = written(blocks(ticks, block_rows, rsi_block, price_scale, periods, key, open_from_close), "blocks")
    # one row per full sub-block: its totals, and the decayed ones of those up to it
    lags = ind.rsi_carry_lags(periods, rsi_block)
    ends = x.where(F.col("_rn") % rsi_block == 0).select(
        key, "_rn", "_r", F.struct("_r", F.col("_gi").alias("_g"), F.col("_li").alias("_l")).alias("_t"),
        "_cpv", "_cv", "_nd")
    back = Window.partitionBy(key).orderBy("_r").rowsBetween(-(lags - 1), 0)
    cg, cl = rsi_carry(F.col("_ts"), ind.rsi_decay(periods, rsi_block))
    carry = (ends.select(key, (F.col("_r") + 1).alias("_r"), F.collect_list("_t").over(back).alias("_ts"))
                 .select(key, F.floor(F.col("_r") / per_block).cast("long").alias("_g"),
                         F.struct("_r", cg.alias("_cg"), cl.alias("_cl")).alias("_c"))
                 .groupBy(key, "_g").agg(F.sort_array(F.collect_list("_c")).alias("_cs")))
    # one row per full block: sums and counts of the blocks up to it
    upto = ind.running(Window.partitionBy(key).orderBy("_rn"))
    btab = ends.where(F.col("_rn") % block_rows == 0).select(
        key, F.floor(F.col("_rn") / block_rows).cast("long").alias("_g"),
        *[F.sum(c).over(upto).alias(c + "0") for c in ("_cpv", "_cv", "_nd")])
    tab = carry.join(btab, [key, "_g"], "left")
    x = x.join(tab, [key, "_g"], "left")

    own = F.get("_cs", (F.col("_r") - F.get("_cs", F.lit(0))["_r"]).cast("int"))
    gsum = F.coalesce(own["_cg"], F.lit(0.0)) + F.col("_gi")
    lsum = F.coalesce(own["_cl"], F.lit(0.0)) + F.col("_li")

    def total(c: str):
        return F.when(F.col(c + "0").isNull(), F.col(c)).otherwise(
            F.col(c + "0") + F.coalesce(F.col(c), F.lit(0).cast(x.schema[c].dataType)))

    units = F.when(F.col("volume").isNotNull(), safe_div(total("_cpv"), total("_cv")))
    x = (x.withColumn("rsi_14", ind.rsi_from_sums(gsum, lsum, total("_nd"), periods))
          .withColumn("vwap", np_round(units, 2) if price_scale is None else ind.units_to_2dp(units, price_scale)))
    return with_flags(x, crash).drop(
        "_rn", "_g", "_halo", "_gain", "_loss", "_cpv", "_cv", "_nd", "_r", "_wt", "_gi", "_li",
        "_cpv0", "_cv0", "_nd0", "_cs")
