"""The split (hot symbol) plan equals the one-window-per-symbol plan."""

import pytest
from pyspark.sql import functions as F

from tickwise.operators.enrich import SeriesStats, enrich
from tickwise.operators.split_enrich import split_enrich

COLS = ["moving_avg_5", "moving_avg_20", "volatility", "rsi_14", "vwap", "volume_trend",
        "price_change_pct", "crash_score", "latency_ms"]


def long_series(spark, n=4000, symbols=3):
    return (spark.range(n * symbols)
            .select(F.concat(F.lit("S"), (F.col("id") % symbols).cast("string")).alias("symbol"),
                    F.col("id").alias("seq"),
                    # equal event times in pairs: order falls back to seq
                    F.timestamp_seconds(F.floor(F.col("id") / (2 * symbols))).cast("timestamp_ntz")
                    .alias("event_time"),
                    (F.lit(100.0) + F.round(F.sin(F.col("id") * 0.37) * 5, 2)).alias("open"),
                    (F.lit(100.0) + F.round(F.sin(F.col("id") * 0.41) * 5 + F.cos(F.col("id") * 0.07), 2))
                    .alias("close"),
                    (F.col("id") % 50).alias("volume"),
                    (F.col("id") * 7).alias("spark_process_time")))


def values(df):
    return sorted((r["seq"], *(r[c] for c in COLS)) for r in df.collect())


def test_split_equals_plain(spark):
    """Bit by bit, RSI included: both plans use the same blocks."""
    df = long_series(spark)
    plain = values(enrich(df, stats=SeriesStats(4000), rsi_block=500))
    assert values(split_enrich(df, block_rows=1000, rsi_block=500)) == plain
    assert values(split_enrich(df, block_rows=3000, rsi_block=500)) == plain
    assert len(plain) == 12000


def test_auto_routes_hot_symbols(spark):
    df = long_series(spark, n=4500, symbols=2).union(
        long_series(spark, n=30, symbols=1).withColumn("symbol", F.lit("COLD"))
        .withColumn("seq", F.col("seq") + 10 ** 6))
    out = enrich(df, split_rows=1000, split_block_rows=2000)     # 3 blocks per hot symbol
    assert values(out) == values(enrich(df, split_rows=10 ** 9))
    assert out.count() == 2 * 4500 + 30


def test_rows_without_a_symbol_are_treated_alike(spark):
    """They belong to no series, whichever plan is chosen."""
    df = long_series(spark, n=300, symbols=2)
    df = df.withColumn("symbol", F.when(F.col("seq") % 10 != 0, F.col("symbol")))
    plain, split = enrich(df, split_rows=10 ** 9), enrich(df, split_rows=50, split_block_rows=40, rsi_block=20)
    assert plain.count() == split.count() == 540
    cols = [c for c in COLS if c != "rsi_14"]
    pick = lambda d: sorted((r["seq"], *(r[c] for c in cols)) for r in d.collect())
    assert pick(plain) == pick(split)
    assert values(enrich(df, split_rows=10 ** 9, rsi_block=20)) == values(split)


@pytest.mark.parametrize("periods", [2, 3, 14])
def test_any_rsi_period(spark, periods):
    df = long_series(spark, n=1500, symbols=1)
    hot = enrich(df, rsi_periods=periods, split_rows=100, split_block_rows=900)
    assert values(hot) == values(enrich(df, rsi_periods=periods))


def test_split_without_price_scale(spark):
    """Double sums: equal up to the last rounded digit."""
    df = long_series(spark, n=600, symbols=1)
    a = values(enrich(df, price_scale=None))
    b = values(enrich(df, price_scale=None, split_rows=100, split_block_rows=200, rsi_block=100))
    for x, y in zip(a, b, strict=True):
        assert all(p == q or abs(p - q) <= 0.011 for p, q in zip(x, y, strict=True))


def test_open_is_derived_inside_the_blocks(spark):
    df = long_series(spark, n=300, symbols=2).drop("open")
    cold = enrich(df, open_from_close=True, rsi_block=20)
    hot = enrich(df, open_from_close=True, split_rows=50, split_block_rows=40, rsi_block=20)
    assert values(hot) == values(cold)


def test_nothing_stays_cached(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    enrich(long_series(spark, n=300), split_rows=50, split_block_rows=40, rsi_block=20).count()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
