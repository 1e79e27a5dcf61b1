"""Decoding, quarantine, time zones, dedup and the sinks' idempotence."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tickwise.operators.snapshot import dedup_ticks
from tickwise.session import checkpoint_dir
from tickwise.sources import sinks, tables
from tickwise.sources.ticks import decode_ticks, encode_ticks, good_ticks, quarantined


def msg(**kw):
    base = {"symbol": "AAPL", "sector": "Tech", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5,
            "volume": 10, "timestamp": "2024-01-02 09:30:00", "kafka_produce_time": 1,
            "data_type": "real"}
    base.update(kw)
    return json.dumps(base)


def test_quarantine_reasons(spark):
    rows = [(1, msg()), (2, "{not json"), (3, msg(timestamp="not-a-time")), (4, msg(symbol=None))]
    d = decode_ticks(spark.createDataFrame(rows, "seq long, value string"))
    reasons = {r["seq"]: r["quarantine"] for r in d.collect()}
    assert reasons == {1: None, 2: "malformed_json", 3: "bad_timestamp", 4: "null_symbol"}
    assert good_ticks(d).count() == 1
    assert quarantined(d).count() == 3


def test_source_time_zone_per_type(spark):
    rows = [(1, msg(data_type="real")), (2, msg(data_type="simulated"))]
    d = decode_ticks(spark.createDataFrame(rows, "seq long, value string"),
                     tz_by_type={"real": "America/New_York"})
    t = {r["seq"]: r["event_time"] for r in d.collect()}
    assert t[1] == dt.datetime(2024, 1, 2, 14, 30) and t[2] == dt.datetime(2024, 1, 2, 9, 30)


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame([("A", None, 1.0, 2.0, 0.5, 1.5, 3, "2024-01-02 09:30:00", None, "real")],
                               "symbol string, sector string, open double, high double, low double, "
                               "close double, volume long, timestamp string, kafka_produce_time long, "
                               "data_type string")
    enc = encode_ticks(df)
    assert '"sector":null' in enc.first()["value"]
    back = good_ticks(decode_ticks(enc.withColumn("seq", F.lit(1))))
    r = back.first()
    assert r["symbol"] == "A" and r["sector"] is None and r["volume"] == 3


def test_dedup_keeps_first_seq(spark):
    t = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([("A", t, 1.0, 1.0, 1.0, 1.0, 5, 7), ("A", t, 1.0, 1.0, 1.0, 1.0, 5, 3),
                                ("A", t, 1.0, 1.0, 1.0, 2.0, 5, 9)],
                               "symbol string, event_time timestamp_ntz, open double, high double, "
                               "low double, close double, volume long, seq long")
    assert sorted(r["seq"] for r in dedup_ticks(df).collect()) == [3, 9]


def test_raw_sink_idempotent_per_batch(spark):
    path = f"{checkpoint_dir(spark)}/test-raw-idem"
    t = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([("A", t, 1.0, 1)], "symbol string, event_time timestamp_ntz, "
                               "close double, volume long").withColumn("date", F.to_date("event_time"))
    sinks.write_raw(df, path, batch_id=5)
    sinks.write_raw(df, path, batch_id=5)
    sinks.write_raw(df, path, batch_id=6)
    assert tables.read_raw(spark, path).count() == 2


def test_read_enriched_defaults(spark):
    path = f"{checkpoint_dir(spark)}/test-legacy"
    spark.createDataFrame([("A", None, "2024-01-02 09:30:00", 1.0), ("B", "X", "bad", 2.0)],
                          "symbol string, sector string, timestamp string, close double") \
        .write.mode("overwrite").parquet(path)
    from pyspark.sql.types import StructType
    schema = spark.read.parquet(path).schema
    df = tables.read_enriched(spark, path, schema=schema)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["sector"] == "Unknown"
    assert rows[0]["event_time"] == dt.datetime(2024, 1, 2, 9, 30)


def test_worker_metrics_reader_skips_blanks_and_nulls_bad_times(spark):
    path = f"{checkpoint_dir(spark)}/test-workers-jsonl"
    lines = ['{"timestamp": "2024-01-02T09:30:00", "worker_id": 1, "messages_sent": 5, "queue_depth": 3}',
             "",
             '{"timestamp": "garbage", "worker_id": 2, "messages_sent": 7, "queue_depth": 1200}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    df = tables.read_worker_metrics(spark, path)
    rows = sorted(df.collect(), key=lambda r: r["worker_id"])
    assert len(rows) == 2
    assert rows[0]["timestamp"] == dt.datetime(2024, 1, 2, 9, 30) and rows[1]["timestamp"] is None
    from tickwise.operators.metrics import queue_depth_alerts
    assert [r["worker_id"] for r in queue_depth_alerts(df).collect()] == [2]
