"""Dashboard result sets as DataFrame functions over the enriched table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tickwise.functions.numeric import safe_div
from tickwise.operators.snapshot import latest_per_symbol, recent_rows

# The columns of the snapshot view, in order.
SNAPSHOT_COLS = ("symbol", "sector", "close", "price_change_pct", "volatility",
                 "moving_avg_5", "volume", "data_type")


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Schema-tolerant projection: keep the wanted columns that exist."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def display_names(df: DataFrame) -> DataFrame:
    """``price_change_pct`` -> ``Price Change Pct`` for presentation."""
    return df.toDF(*[c.replace("_", " ").title() for c in df.columns])


def market_snapshot(df: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    latest = latest if latest is not None else latest_per_symbol(df)
    return select_available(latest, SNAPSHOT_COLS)


def market_kpis(df: DataFrame) -> DataFrame:
    """Symbols tracked, total rows, mean latency, crash count."""
    return df.agg(F.countDistinct("symbol").alias("symbols"),
                  F.count(F.lit(1)).alias("total_events"),
                  F.avg("latency_ms").alias("avg_latency_ms"),
                  F.count_if(F.col("crash_score")).alias("crash_signals"))


def sector_performance(df: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Mean price change of each sector's latest rows, ascending."""
    latest = latest if latest is not None else latest_per_symbol(df)
    return (latest.groupBy("sector")
                  .agg(F.avg("price_change_pct").alias("avg_price_change_pct"))
                  .orderBy("avg_price_change_pct", "sector"))


def top_movers(df: DataFrame, k: int = 5, gainers: bool = True,
               latest: DataFrame | None = None) -> DataFrame:
    """Top-k gainers (or losers) by latest price change; ties by symbol."""
    latest = latest if latest is not None else latest_per_symbol(df)
    pct = F.col("price_change_pct")
    return (latest.where(pct.isNotNull())
                  .orderBy(pct.desc() if gainers else pct.asc(), F.col("symbol"))
                  .limit(k)
                  .select("symbol", "close", "price_change_pct"))


def change_sign(df: DataFrame, col: str = "price_change_pct") -> DataFrame:
    """up / down / flat class of a change (null stays null)."""
    c = F.col(col)
    return df.withColumn("change_sign", F.when(c > 0, "up").when(c < 0, "down")
                         .when(c == 0, "flat"))


def ma_divergence(df: DataFrame) -> DataFrame:
    """(MA5 - MA20) / MA20 * 100 per row, null (zero MA20) rows dropped."""
    div = safe_div(F.col("moving_avg_5") - F.col("moving_avg_20"), F.col("moving_avg_20")) * F.lit(100.0)
    return (df.select("symbol", "event_time", "seq", div.alias("ma_div_pct"))
              .where(F.col("ma_div_pct").isNotNull())
              .withColumn("signal", F.when(F.col("ma_div_pct") >= 0, "bullish").otherwise("bearish")))


def vwap_signals(df: DataFrame, latest: DataFrame | None = None,
                 oversold: float = 30.0, overbought: float = 70.0) -> DataFrame:
    """VWAP deviation % against RSI zone for each symbol's latest values."""
    latest = latest if latest is not None else latest_per_symbol(df)
    s = latest.dropna(subset=["rsi_14", "vwap", "close"]).where(F.col("vwap") > 0)
    dev = (F.col("close") - F.col("vwap")) / F.col("vwap") * F.lit(100.0)
    zone = (F.when(F.col("rsi_14") < oversold, "oversold")
             .when(F.col("rsi_14") > overbought, "overbought").otherwise("neutral"))
    return s.select("symbol", "sector", "rsi_14", dev.alias("vwap_dev_pct"), zone.alias("rsi_zone"))


def risk_cube(df: DataFrame, n: int = 500) -> DataFrame:
    """Volatility x RSI x log volume of the newest ``n`` rows (complete rows only)."""
    r = recent_rows(df, n).dropna(subset=["volatility", "rsi_14", "volume", "price_change_pct"])
    return r.select("symbol", "event_time", "seq", "volatility", "rsi_14",
                    F.log1p(F.col("volume")).alias("log_volume"), "price_change_pct")


def anomaly_split(df: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Latest points split into crash / normal with a volatility-scaled size."""
    latest = latest if latest is not None else latest_per_symbol(df)
    s = latest.dropna(subset=["volume_trend", "price_change_pct"])
    size = F.least(F.greatest(F.coalesce(F.col("volatility"), F.lit(0.5)) * F.lit(80.0) + F.lit(30.0),
                              F.lit(20.0)), F.lit(200.0))
    return s.select("symbol", "volume_trend", "price_change_pct",
                    F.coalesce(F.col("crash_score"), F.lit(False)).alias("is_crash"),
                    size.alias("point_size"))


def price_volume_time(df: DataFrame, n: int = 500) -> DataFrame:
    """Newest ``n`` rows with seconds since their first row and a symbol code."""
    r = recent_rows(df, n)
    # both windows see the ``n`` rows of the top-k only
    t0 = F.min("event_time").over(Window.partitionBy())
    code = (F.dense_rank().over(Window.orderBy("symbol")) - 1).cast("long")
    return r.select("symbol", "event_time", "seq", "close", "volume",
                    (F.timestamp_diff("MICROSECOND", t0, F.col("event_time")) / 1e6).alias("t_seconds"),
                    code.alias("symbol_ordinal"))


def crash_summary(df: DataFrame) -> DataFrame:
    """Crash count, affected symbols and the worst drop among crash rows."""
    crash = F.col("crash_score") == F.lit(True)
    return df.agg(F.count_if(crash).alias("total_crashes"),
                  F.countDistinct(F.when(crash, F.col("symbol"))).alias("affected_symbols"),
                  F.min(F.when(crash, F.col("price_change_pct"))).alias("worst_drop_pct"))


# The columns of the crash history view, in order.
CRASH_COLS = ("event_time", "symbol", "sector", "close", "price_change_pct",
              "volume_trend", "volatility")


def crash_history(df: DataFrame, n: int = 50) -> DataFrame:
    """The newest ``n`` crash rows."""
    c = df.where(F.col("crash_score") == F.lit(True))
    return (c.orderBy(F.col("event_time").desc(), F.col("seq").desc()).limit(n)
             .select(*CRASH_COLS, "seq"))


def crash_timeline(df: DataFrame) -> DataFrame:
    """Every crash point (symbol, time, change)."""
    return (df.where(F.col("crash_score") == F.lit(True))
              .select("symbol", "event_time", "seq", "price_change_pct"))


def distinct_symbols(df: DataFrame) -> DataFrame:
    """Distinct (sector, symbol) pairs in order, null symbols dropped."""
    return (df.where(F.col("symbol").isNotNull()).select("sector", "symbol").distinct()
              .orderBy("sector", "symbol"))


def distinct_sectors(df: DataFrame) -> DataFrame:
    """Sorted list of sectors, null ones dropped."""
    return df.where(F.col("sector").isNotNull()).select("sector").distinct().orderBy("sector")


def symbol_series(df: DataFrame, symbol: str) -> DataFrame:
    """One symbol's price/volume/MA/VWAP series in time order (filter pushed
    below the window)."""
    return (df.where(F.col("symbol") == symbol)
              .select("symbol", "event_time", "seq", "close", "high", "low", "volume",
                      "moving_avg_5", "moving_avg_20", "vwap")
              .orderBy("event_time", "seq"))
