"""A key of the keyed stream holds many symbols; their series stay apart."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickwise.streaming.kernel import SymbolState, advance
from tickwise.streaming.stateful import _IND, _PASS, enrich_stream, make_state_fn


class State:
    """What the function needs of Spark's ``GroupState``."""

    def __init__(self):
        self.value, self.hasTimedOut, self.watermark, self.timeout = None, False, 0, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutTimestamp(self, t):
        self.timeout = t


def rows(symbol, minutes, seq0, volume=10):
    t0 = dt.datetime(2024, 1, 2, 9)
    return [{"symbol": symbol, "sector": None, "open": 100.0 + m, "high": 1.0, "low": 1.0, "close": 100.0 + (m * 7) % 5,
             "volume": volume + m, "event_time": t0 + dt.timedelta(minutes=m), "kafka_produce_time": None if m % 3 else 4,
             "data_type": "real", "timestamp": "", "seq": seq0 + m, "spark_process_time": 9, "date": t0.date()}
            for m in minutes]


def ms(minute):
    return int(dt.datetime(2024, 1, 2, 9, minute, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_symbols_of_a_bucket_stay_apart():
    fn, state = make_state_fn(), State()
    first = pd.DataFrame(rows("A", range(0, 20), 0) + rows("B", range(0, 20), 100, 500))[_PASS].sample(frac=1, random_state=1)
    assert list(fn((3,), iter([first]), state)) == [] and state.timeout is not None
    state.watermark = ms(15)
    second = pd.DataFrame(rows("B", range(20, 30), 100, 500))[_PASS]
    out = list(fn((3,), iter([second]), state))
    state.watermark = ms(40)
    out += list(fn((3,), iter([pd.DataFrame(rows("A", [4], 900))[_PASS]]), state))
    got = pd.concat(out)
    assert got[got["late"]]["seq"].tolist() == [904] and got[got["late"]][_IND].isna().all(axis=None)
    for symbol, n, seq0, volume in (("A", 20, 0, 10), ("B", 30, 100, 500)):
        want = pd.DataFrame(rows(symbol, range(n), seq0, volume))
        ind = advance(SymbolState(), want["open"].values, want["close"].values, want["volume"].values)
        mine = got[(got["symbol"] == symbol) & ~got["late"]]
        assert mine["seq"].tolist() == want["seq"].tolist()
        for c in _IND:
            assert np.allclose(mine[c].astype(float), ind[c], equal_nan=True, atol=0.011), (symbol, c)


def test_keys_do_not_grow_with_symbols(spark, tmp_path):
    ticks = (spark.range(300).select(F.concat(F.lit("S"), F.col("id") % 100).alias("symbol"), F.lit(1.0).alias("open"),
                                     (F.col("id") % 7).cast("double").alias("close"), F.lit(5).cast("long").alias("volume"),
                                     F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz").alias("event_time"),
                                     F.col("id").alias("seq")))
    ticks.write.parquet(f"{tmp_path}/in")
    src = spark.readStream.schema(ticks.schema).parquet(f"{tmp_path}/in")
    q = (enrich_stream(src, buckets=4).writeStream.format("parquet").option("path", f"{tmp_path}/out")
         .option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= 4
