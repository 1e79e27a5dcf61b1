"""Golden micro-fixture: one symbol, 17 ticks, every indicator."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickwise.operators.enrich import enrich

# n, open, close, volume
ROWS = [(1, 100, 100, 10), (2, 100, 101, 20), (3, 101, 102, 0), (4, 102, 101, 0),
        (5, 101, 103, 0), (6, 103, 99, 0), (7, 99, 98, 0), (8, 98, 100, 40),
        (9, 100, 104, 10), (10, 104, 105, 10), (11, 105, 104, 20), (12, 104, 106, 20),
        (13, 106, 107, 10), (14, 107, 105, 10), (15, 105, 108, 30), (16, 108, 110, 10),
        (17, 110, 96, 200)]

# n: moving_avg_5, moving_avg_20, volatility, rsi_14, vwap, volume_trend, price_change_pct, crash
EXPECTED = {
    1: (100.0, 100.0, None, None, 100.0, 1.0, 0.0, False),
    2: (100.5, 100.5, 0.7071, None, 100.67, 1.333, 1.0, False),
    3: (101.0, 101.0, 1.0, None, 100.67, 0.0, 0.99, False),
    4: (101.0, 101.0, 0.8165, None, 100.67, 0.0, -0.98, False),
    5: (101.4, 101.4, 1.1402, None, 100.67, 0.0, 1.98, False),
    6: (101.2, 101.0, 1.4832, None, 100.67, 0.0, -3.88, False),
    7: (100.6, 100.57, 2.0736, None, 100.67, None, -1.01, False),
    8: (100.2, 100.5, 1.9235, None, 100.29, 5.0, 2.04, False),
    9: (100.8, 100.89, 2.5884, None, 100.75, 1.0, 4.0, False),
    10: (101.2, 101.3, 3.1145, None, 101.22, 0.833, 0.96, False),
    11: (102.2, 101.55, 3.0332, None, 101.73, 1.25, -0.95, False),
    12: (103.8, 101.92, 2.2804, None, 102.38, 1.0, 1.92, False),
    13: (105.2, 102.31, 1.3038, None, 102.71, 0.714, 0.94, False),
    14: (105.4, 102.5, 1.1402, None, 102.87, 0.714, -1.87, False),
    15: (106.0, 102.87, 1.5811, 67.35, 103.72, 1.667, 2.86, False),
    16: (107.2, 103.31, 1.9235, 70.97, 104.05, 0.625, 1.85, False),
    17: (105.2, 102.88, 5.4498, 38.69, 99.92, 3.846, -12.73, True),
}
COLS = ["moving_avg_5", "moving_avg_20", "volatility", "rsi_14", "vwap", "volume_trend",
        "price_change_pct", "crash_score"]


def fixture_df(spark, rows=ROWS, symbol="GOLD"):
    t0 = dt.datetime(2024, 1, 2, 9, 30)
    data = [(symbol, "Tech", n, t0 + dt.timedelta(minutes=n), float(o), float(c), int(v))
            for n, o, c, v in rows]
    return spark.createDataFrame(
        data, "symbol string, sector string, seq long, event_time timestamp_ntz, "
              "open double, close double, volume long")


def test_golden_fixture(spark):
    out = {r["seq"]: r for r in enrich(fixture_df(spark)).collect()}
    assert len(out) == 17
    for n, exp in EXPECTED.items():
        got = tuple(out[n][c] for c in COLS)
        for c, g, e in zip(COLS, got, exp):
            if e is None:
                assert g is None, (n, c, g)
            elif isinstance(e, bool):
                assert g is e, (n, c, g)
            else:
                assert g == pytest.approx(e, abs=1e-9), (n, c, g, e)


def test_equal_event_times_ordered_by_seq(spark):
    t = dt.datetime(2024, 1, 2, 9, 30)
    df = spark.createDataFrame(
        [("A", 2, t, 1.0, 2.0, 1), ("A", 1, t, 1.0, 1.0, 1)],
        "symbol string, seq long, event_time timestamp_ntz, open double, close double, volume long")
    r = {x["seq"]: x for x in enrich(df).collect()}
    assert r[1]["moving_avg_5"] == 1.0 and r[2]["moving_avg_5"] == 1.5


def test_rising_closes_have_null_rsi(spark):
    rows = [(n, 100 + n, 101 + n, 10) for n in range(1, 21)]
    out = enrich(fixture_df(spark, rows)).collect()
    assert all(r["rsi_14"] is None for r in out)


def test_zero_open_and_zero_volume(spark):
    rows = [(1, 0, 10, 0), (2, 10, 11, 0)]
    r = {x["seq"]: x for x in enrich(fixture_df(spark, rows)).collect()}
    assert r[1]["price_change_pct"] is None and r[1]["crash_score"] is False
    assert r[1]["vwap"] is None and r[2]["volume_trend"] is None


def test_missing_produce_time_latency_zero(spark):
    df = fixture_df(spark, ROWS[:2]).withColumn("kafka_produce_time", F.lit(None).cast("long")) \
        .withColumn("spark_process_time", F.lit(1000).cast("long"))
    assert {r["latency_ms"] for r in enrich(df).collect()} == {0}
