"""Stateful streaming enrichment (keyed by buckets of symbols).

``enrich_stream`` groups a streaming tick frame by a hash of the symbol into
``BUCKETS`` buckets and runs ``applyInPandasWithState``: Spark's cost of a
key in every batch is far above that of a symbol's few rows.  Per symbol
the state holds O(1) numbers (running sums, the last 19 closes and 4
volumes, the decayed RSI sums), and per bucket a buffer of rows whose
event time is still above the watermark.

Two event-time bounds:
* ``watermark`` (merge delay, default 5 minutes): a row is emitted, in
  (event_time, seq) order, once the newest event time seen is at least
  this far past it.  So the output equals the batch ``enrich`` however
  the input is cut into micro-batches, as long as rows arrive within
  the delay.
* ``late_horizon`` (default 20 years): Spark's own watermark delay.  A row
  older than the last emitted row of its symbol reaches the state function
  and is emitted once with ``late = true`` and null indicators (the late
  output).  Spark drops what is older than the horizon before the state
  sees it, so the horizon is wider than the span of event times that
  ``decode_ticks`` accepts; it costs no state, because nothing waits for it.
"""

from __future__ import annotations

import json
import pickle
import re
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickwise.functions.indicators import CrashRule
from tickwise.functions.timefns import utc_instant
from tickwise.session import ship_package
from tickwise.schema import ENRICHED_TICK
from tickwise.streaming.kernel import SymbolState, advance

OUT_FIELDS = [f for f in ENRICHED_TICK.fields]
OUTPUT_SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in OUT_FIELDS) + ", late boolean"
STATE_SCHEMA = "series string, buffer binary"
BUCKETS = 1024     # state keys; Spark's cost of a key and batch is that of hundreds of rows

# Wider than ``sources.ticks.MAX_AGE`` plus its tolerance.
LATE_HORIZON = "7300 days"

_PASS = ["symbol", "sector", "open", "high", "low", "close", "volume", "event_time",
         "kafka_produce_time", "data_type", "timestamp", "seq", "spark_process_time", "date"]
_IND = ["moving_avg_5", "moving_avg_20", "volatility", "rsi_14", "vwap", "volume_trend",
        "price_change_pct"]
_OUT = [f.name for f in OUT_FIELDS] + ["late"]


def _us(t: np.ndarray) -> np.ndarray:
    return t.astype("datetime64[us]").astype(np.int64)


def _joined(parts: list[dict]) -> dict:
    """Column by column; one part stays as it is."""
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _floats(a: np.ndarray) -> np.ndarray:
    return pd.Series(a).astype(float).to_numpy() if a.dtype == object else a.astype(np.float64)


def _load(state: GroupState):
    """({symbol: (SymbolState, last event time, last seq)}, rows that wait) of a bucket."""
    if not state.exists:
        return {}, None
    series, buf = state.get
    series = {k: (SymbolState(**st), t, seq) for k, (st, t, seq) in json.loads(series).items()}
    # pickled arrays keep the buffered rows bit-exact (types and doubles); only ``_save`` writes them
    return series, pickle.loads(bytes(buf)) if buf else None


def _save(state: GroupState, series: dict, buf: dict | None):
    enc = pickle.dumps(buf, protocol=pickle.HIGHEST_PROTOCOL) if buf is not None else None
    state.update((json.dumps({k: (st.__dict__, t, seq) for k, (st, t, seq) in series.items()}), enc))


_UNITS_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
             "day": 86_400_000, "week": 604_800_000}


def interval_ms(text: str) -> int:
    """'5 minutes' -> 300000."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text.lower())
    if not m or m.group(2) not in _UNITS_MS:
        raise ValueError(f"unsupported interval {text!r}")
    return int(m.group(1)) * _UNITS_MS[m.group(2)]


def make_state_fn(periods: int = 14, crash: CrashRule = CrashRule(), slack_ms: int = 0):
    """``slack_ms`` = late_horizon - merge delay: rows are emitted once
    Spark's watermark + slack (= newest event time - merge delay) passes them."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] is None:          # end-of-input markers and keyless rows
            for _ in pdfs:
                pass
            return
        series, buf = _load(state)
        # columns stay arrays, and one frame is made of all that a bucket emits
        parts = [buf] if buf is not None else []
        parts += [{c: p[c].to_numpy() for c in _PASS} for p in pdfs if len(p)]
        if not parts:
            if state.hasTimedOut:
                state.remove()
            return
        rows = _joined(parts)
        if pd.isna(rows["spark_process_time"]).all():
            rows["spark_process_time"] = np.full(len(rows["seq"]), int(time.time() * 1000))
        t, seq = _us(rows["event_time"]), rows["seq"].astype(np.int64)
        symbols, of = np.unique(rows["symbol"], return_inverse=True)
        before = [series.get(k, (None, None, None))[1:] for k in symbols]
        known = np.array([x is not None for x, _ in before])[of]
        last_t = np.array([x or 0 for x, _ in before], dtype=np.int64)[of]
        last_seq = np.array([x or 0 for _, x in before], dtype=np.int64)[of]
        late = known & ((t < last_t) | ((t == last_t) & (seq <= last_seq)))
        wm_ms = state.getCurrentWatermarkMs()
        ready = (~late) & (t <= (wm_ms + slack_ms) * 1000)
        out = []
        if late.any():
            lr = {c: a[late] for c, a in rows.items()}
            n = len(lr["seq"])
            lr.update({c: np.full(n, np.nan) for c in _IND})
            out.append({**lr, "crash_score": np.zeros(n, dtype=bool), "late": np.ones(n, dtype=bool)})
        if ready.any():
            at = np.flatnonzero(ready)
            at = at[np.lexsort((seq[at], t[at], of[at]))]
            emit = {c: a[at] for c, a in rows.items()}
            has_volume = ~pd.isna(emit["volume"])
            volume = np.where(has_volume, emit["volume"], 0).astype(np.int64)
            open_, close = _floats(emit["open"]), _floats(emit["close"])
            ends = np.append(np.flatnonzero(np.diff(of[at])) + 1, len(at))
            found, start = [], 0
            for end in ends.tolist():
                k, last, one = symbols[of[at[start]]], at[end - 1], slice(start, end)
                st = series[k][0] if k in series else SymbolState()
                found.append(advance(st, open_[one], close[one], volume[one], periods, has_volume[one]))
                series[k] = (st, int(t[last]), int(seq[last]))
                start = end
            emit.update({c: np.concatenate([f[c] for f in found]) for c in _IND})
            vo = emit["volatility"]
            emit["crash_score"] = ((emit["price_change_pct"] < crash.pct_below)
                                   & (emit["volume_trend"] > crash.volume_trend_above)
                                   & (np.where(np.isnan(vo), 0.0, vo) > crash.volatility_above))
            emit["late"] = np.zeros(len(at), dtype=bool)
            out.append(emit)
        wait = ~(late | ready)
        rest = None
        if wait.any():
            rest = rows if wait.all() else {c: a[wait] for c, a in rows.items()}
        _save(state, series, rest)
        if rest is not None:
            nxt = int(t[wait].min() // 1000) - slack_ms
            state.setTimeoutTimestamp(max(nxt, wm_ms + 1))
        for o in out:
            done, made = pd.Series(o["spark_process_time"]), pd.Series(o["kafka_produce_time"])
            o["latency_ms"] = (done - made.fillna(done)).astype("int64").to_numpy()
            yield pd.DataFrame({c: o[c] for c in _OUT}, copy=False)
    return fn


def enrich_stream(ticks: DataFrame, watermark: str = "5 minutes", periods: int = 14,
                  crash: CrashRule = CrashRule(), late_horizon: str = LATE_HORIZON, buckets: int = BUCKETS) -> DataFrame:
    """Streaming ``enrich``: typed ticks in, enriched (+ late) rows out.

    ``ticks`` needs the tick columns plus ``seq``; rows are hash-
    partitioned by bucket of symbols into the state store (RocksDB or HDFS-backed,
    checkpointed), so executor loss replays from the checkpoint.
    """
    ship_package(ticks.sparkSession)          # the state function runs in Python workers
    cols = [c for c in _PASS if c in ticks.columns]
    # the watermark column stays in the grouped input: event-time timeouts need it
    s = (ticks.select(*cols)
              .withColumn("_wm", utc_instant("event_time"))
              .withWatermark("_wm", late_horizon))
    slack = interval_ms(late_horizon) - interval_ms(watermark)
    if slack < 0:
        raise ValueError("late_horizon must not be shorter than the merge delay")
    for c in _PASS:
        if c not in s.columns:
            s = s.withColumn(c, F.lit(None).cast(dict((f.name, f.dataType) for f in OUT_FIELDS)[c]))
    bucket = F.when(F.col("symbol").isNotNull(), F.pmod(F.xxhash64("symbol"), F.lit(buckets)))
    return s.withColumn("_bucket", bucket).groupBy("_bucket").applyInPandasWithState(
        make_state_fn(periods, crash, slack), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)
