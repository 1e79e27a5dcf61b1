"""Edge inputs: snapshot modes, empty batches, null symbols and sectors."""

import datetime as dt

from pyspark.sql import functions as F

from tickwise.operators import snapshot, views
from tickwise.streaming.job import SinkPaths, write_enrichment_batch
from tickwise.streaming.stateful import OUTPUT_SCHEMA
from tickwise.session import checkpoint_dir


def test_latest_non_null_mixes_rows(spark):
    t = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("A", t, 1, 50.0, 1.0), ("A", t + dt.timedelta(minutes=1), 2, None, 2.0)],
        "symbol string, event_time timestamp_ntz, seq long, rsi_14 double, close double")
    nn = snapshot.latest_per_symbol(df).first()
    assert nn["rsi_14"] == 50.0 and nn["close"] == 2.0
    row = snapshot.latest_per_symbol(df, mode="row").first()
    assert row["rsi_14"] is None and row["seq"] == 2


def test_empty_micro_batch_writes_nothing(spark):
    root = f"{checkpoint_dir(spark)}/test-empty-batch"
    paths = SinkPaths(enriched=f"{root}/e", late=f"{root}/l", metrics=f"{root}/m")
    empty = spark.createDataFrame([], OUTPUT_SCHEMA)
    write_enrichment_batch(paths)(empty, 0)
    import os
    assert not os.path.exists(f"{root}/e") and not os.path.exists(f"{root}/m")


def test_null_sector_shown_unknown(spark):
    df = spark.createDataFrame([("A", None, 1.0)], "symbol string, sector string, price_change_pct double")
    out = views.sector_performance(None, snapshot.sector_default(df)).first()
    assert out["sector"] == "Unknown"


def test_recent_window_relative_to_data_max(spark):
    t = dt.datetime(2024, 1, 2, 12, 0)
    df = spark.createDataFrame([(t - dt.timedelta(minutes=m), m) for m in (0, 5, 6, 60)],
                               "event_time timestamp_ntz, m int")
    assert sorted(r["m"] for r in snapshot.recent_window(df, 5).collect()) == [0, 5]
    assert snapshot.recent_window(df, 0).count() == 4


def test_histogram_single_value(spark):
    from tickwise.operators.quality import histogram
    df = spark.createDataFrame([(7,), (7,)], "latency_ms long")
    rows = histogram(df, "latency_ms", 30).collect()
    assert len(rows) == 1 and rows[0]["count"] == 2


def test_corr_gate_needs_enough_symbols(spark):
    from tickwise.operators.correlation import corr_matrix
    t = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([("A", t + dt.timedelta(minutes=i), float(i)) for i in range(30)] +
                               [("B", t + dt.timedelta(minutes=i), float(i * i)) for i in range(30)],
                               "symbol string, event_time timestamp_ntz, close double")
    assert corr_matrix(df).count() == 0
    assert corr_matrix(df, min_symbols=2).where("symbol_a = 'A' AND symbol_b = 'A'").first()["corr"] == 1.0


def test_corr_drops_constant_symbol(spark):
    from tickwise.operators.correlation import corr_matrix
    t = dt.datetime(2024, 1, 2)
    rows = ([("A", t + dt.timedelta(minutes=i), float(i)) for i in range(30)]
            + [("B", t + dt.timedelta(minutes=i), 5.0) for i in range(30)]
            + [("C", t + dt.timedelta(minutes=i), float(i % 7)) for i in range(30)])
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, close double")
    out = {(r["symbol_a"], r["symbol_b"]): r["corr"] for r in corr_matrix(df, min_symbols=2).collect()}
    assert set(out) == {("A", "A"), ("A", "C"), ("C", "C")}


def test_display_names_and_available_columns(spark):
    df = spark.createDataFrame([("A", 1.0)], "symbol string, price_change_pct double")
    out = views.display_names(views.select_available(df, ["symbol", "sector", "price_change_pct"]))
    assert out.columns == ["Symbol", "Price Change Pct"]
