"""Per-tick indicator enrichment (moving averages, volatility, RSI, VWAP,
volume trend, price change, crash flag, latency).

Plan shape: every indicator is a window expression over one ordered
window ``partitionBy(symbol).orderBy(event_time, seq)``, so the whole
enrichment is one hash exchange on ``symbol`` plus one sort.  RSI weights
restart every ``rsi_block_rows`` rows, and a longer series carries the
decayed totals of the blocks before, gathered by a range frame over the
block number inside the same exchange.

Symbols that hold a large share of all rows are split by time (see
``tickwise.operators.split_enrich``) so that no single task owns a hot
series; both plans use the same blocks and give the same values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwise.functions import indicators as ind

ORDER_COLS = ("event_time", "seq")

# A series longer than this is enriched by the split plan (row blocks),
# so no task holds more than about this many rows of one symbol.
SPLIT_ROWS = 5_000_000


@dataclass(frozen=True)
class SeriesStats:
    """Per-call facts about the input that steer the physical plan."""
    max_rows: int


def rows_per_key(ticks: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows per symbol; partial aggregation keeps the shuffle to one row
    per symbol and map task, and only the key column is read."""
    return ticks.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def series_stats(ticks: DataFrame, key: str = "symbol") -> SeriesStats:
    """One small aggregate job: the longest series."""
    ticks = usable(ticks, key)
    return SeriesStats(int(rows_per_key(ticks, key).agg(F.max("_n")).first()[0] or 0))


def usable(ticks: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows that belong to a series: a symbol and an event time."""
    return ticks.where(F.col(key).isNotNull() & F.col("event_time").isNotNull())


def symbol_window(key: str = "symbol"):
    return Window.partitionBy(key).orderBy(*ORDER_COLS)


def rsi_carry(totals: Column, decay: float) -> tuple[Column, Column]:
    """Decayed gain and loss sums of the blocks before, from an array of
    (_r, _g, _l) totals; added in block order, so every plan adds alike."""
    zero = F.struct(F.lit(0.0).alias("g"), F.lit(0.0).alias("l"))
    sums = F.aggregate(F.sort_array(totals), zero, lambda a, t: F.struct(
        ((a["g"] + t["_g"]) * decay).alias("g"), ((a["l"] + t["_l"]) * decay).alias("l")))
    return sums["g"], sums["l"]


def with_rsi(df: DataFrame, periods: int = 14, key: str = "symbol",
             stats: SeriesStats | None = None, block: int | None = None) -> DataFrame:
    """Add ``rsi_14`` (RSI over ``periods``) to an ordered tick frame."""
    if stats is None:
        df = usable(df, key)
        stats = series_stats(df, key)
    B = block or ind.rsi_block_rows(periods)
    growth = ind.rsi_growth(periods)
    w = symbol_window(key)
    g, l = ind.gain_loss("close", w)
    many = stats.max_rows > B
    x = (df.select("*", (F.row_number().over(w) - 1).alias("_rn0"), g.alias("_g"), l.alias("_l"))
           .withColumn("_r", F.floor(F.col("_rn0") / B).cast("long")))
    x = x.withColumn("_wt", F.pow(F.lit(growth), (F.col("_rn0") - F.col("_r") * B).cast("double")))
    inner = ind.running(Window.partitionBy(key, "_r").orderBy(*ORDER_COLS) if many else w)
    x = x.select("*", F.count("_g").over(ind.running(w)).alias("_nd"),
                 F.sum(F.col("_g") * F.col("_wt")).over(inner).alias("_gi"),
                 F.sum(F.col("_l") * F.col("_wt")).over(inner).alias("_li"))
    gsum, lsum = F.col("_gi"), F.col("_li")
    if many:
        # a block's running sums at its last row are its totals
        total = F.when((F.col("_rn0") + 1) % B == 0,
                       F.struct("_r", F.col("_gi").alias("_g"), F.col("_li").alias("_l")))
        before = Window.partitionBy(key).orderBy("_r").rangeBetween(-ind.rsi_carry_lags(periods, B), -1)
        x = x.withColumn("_t", total).withColumn("_t", F.collect_list("_t").over(before))
        cg, cl = rsi_carry(F.col("_t"), ind.rsi_decay(periods, B))
        gsum, lsum = cg + gsum, cl + lsum
    return (x.withColumn("rsi_14", ind.rsi_from_sums(gsum, lsum, F.col("_nd"), periods))
             .drop("_rn0", "_g", "_l", "_r", "_wt", "_nd", "_gi", "_li", "_t"))


def with_defaults(ticks: DataFrame) -> DataFrame:
    if "spark_process_time" not in ticks.columns:
        ticks = ticks.withColumn("spark_process_time", F.unix_millis(F.current_timestamp()))
    if "kafka_produce_time" not in ticks.columns:
        ticks = ticks.withColumn("kafka_produce_time", F.lit(None).cast("long"))
    return ticks


def with_open(df: DataFrame, w) -> DataFrame:
    """``open`` = the close before (its own for the first tick), high and low from both."""
    return (df.withColumn("open", F.coalesce(F.lag("close").over(w), F.col("close")))
              .withColumn("high", F.greatest("open", "close"))
              .withColumn("low", F.least("open", "close")))


def enrich(ticks: DataFrame, price_scale: int | None = 2,
           crash: ind.CrashRule = ind.CrashRule(), rsi_periods: int = 14,
           stats: SeriesStats | None = None, key: str = "symbol",
           split_rows: int = SPLIT_ROWS, split_block_rows: int = 1_000_000,
           rsi_block: int | None = None, open_from_close: bool = False) -> DataFrame:
    """All indicators for every tick.

    Symbols with more than ``split_rows`` rows go through the split plan
    (:mod:`tickwise.operators.split_enrich`); the rest use one window per
    symbol.  Both give the same values.

    ``ticks`` needs symbol, event_time, seq, open, close, volume and
    optionally kafka_produce_time / spark_process_time; with
    ``open_from_close`` open, high and low are derived from the closes.
    Rows without a symbol or an event time belong to no series and are
    left out before any plan is chosen (``tickwise.sources.ticks.
    decode_ticks`` quarantines them, so they are counted there).
    ``stats`` (from :func:`series_stats`) may be passed to skip the
    planning job.
    """
    if rsi_periods < 2:
        raise ValueError("rsi_periods must be at least 2")
    ticks = usable(ticks, key)
    if stats is None:
        stats = series_stats(ticks, key)
    if stats.max_rows > split_rows:
        from tickwise.operators.split_enrich import split_enrich
        # the hot keys stay a table: at most n_rows / split_rows names, joined by size
        hot = rows_per_key(ticks, key).where(F.col("_n") > split_rows).select(key)
        plain = enrich(ticks.join(hot, key, "left_anti").select(*ticks.columns), price_scale, crash,
                       rsi_periods, SeriesStats(split_rows), key, split_rows, split_block_rows,
                       rsi_block, open_from_close)
        split = split_enrich(ticks.join(hot, key, "left_semi").select(*ticks.columns), split_block_rows,
                             rsi_block, price_scale, crash, rsi_periods, key, open_from_close)
        return plain.unionByName(split.select(*plain.columns))
    w = symbol_window(key)
    if open_from_close:
        ticks = with_open(ticks, w)
    ticks = with_defaults(ticks)
    # one select: Catalyst evaluates all frames of ``w`` in one Window operator
    out = ticks.select(
        "*",
        ind.moving_avg("close", w, 5, price_scale).alias("moving_avg_5"),
        ind.moving_avg("close", w, 20, price_scale).alias("moving_avg_20"),
        ind.volatility("close", w, 5, price_scale).alias("volatility"),
        ind.vwap("close", "volume", w, price_scale).alias("vwap"),
        ind.volume_trend("volume", w, 5).alias("volume_trend"),
        ind.price_change_pct("open", "close", price_scale).alias("price_change_pct"))
    out = with_rsi(out, rsi_periods, key, stats, rsi_block)
    return with_flags(out, crash)


def with_flags(out: DataFrame, crash: ind.CrashRule) -> DataFrame:
    return (out
            .withColumn("crash_score", ind.crash_flag(F.col("price_change_pct"),
                                                      F.col("volume_trend"),
                                                      F.col("volatility"), crash))
            .withColumn("latency_ms", ind.latency_ms(F.col("spark_process_time"),
                                                     F.col("kafka_produce_time"))))
