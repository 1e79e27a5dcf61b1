"""Long series: block-rebased RSI equals the plain weights, and stays
finite where plain weights would overflow."""

import math

import pytest
from pyspark.sql import functions as F

from tickwise.operators.enrich import SeriesStats, with_rsi


def series(spark, n, symbols=2):
    # deterministic walk with gains and losses
    return (spark.range(n * symbols)
            .select(F.concat(F.lit("S"), (F.col("id") % symbols).cast("string")).alias("symbol"),
                    F.col("id").alias("seq"),
                    F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("event_time"),
                    (F.lit(100.0) + F.round(F.sin(F.col("id") * 0.37) * 5 + F.cos(F.col("id") * 0.11), 2))
                    .alias("close")))


def test_blocked_equals_plain(spark):
    """Weights that restart every 2,000 or 100 rows, against one run of weights."""
    df = series(spark, 3000)
    plain = {r["seq"]: r["rsi_14"] for r in with_rsi(df, stats=SeriesStats(3000), block=5000).collect()}
    for block in (None, 100):
        blocked = {r["seq"]: r["rsi_14"] for r in with_rsi(df, stats=SeriesStats(10 ** 9), block=block).collect()}
        assert plain.keys() == blocked.keys()
        assert not [k for k in plain if plain[k] != blocked[k]
                    and not (None not in (plain[k], blocked[k]) and abs(plain[k] - blocked[k]) <= 0.01)]


def test_blocked_long_series_finite(spark):
    df = series(spark, 12000, symbols=1)
    out = with_rsi(df).where(F.col("seq") > 11000).collect()
    vals = [r["rsi_14"] for r in out]
    assert all(v is not None and 0 <= v <= 100 and math.isfinite(v) for v in vals)
