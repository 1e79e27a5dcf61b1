"""Vectorised indicator update for one symbol, used by the stateful
streaming enrichment.

Given the carried state of a symbol and its next rows (already in
(event_time, seq) order) it returns the indicator columns and the new
state.  The arithmetic mirrors the batch column builders: prices in
integer cents, exact integer window sums, numpy rounding (half to even),
so a stream gives the batch answers however it is split into batches.
RSI uses the O(1) recurrence G <- G*q + gain (q = 1 - 1/periods),
evaluated per chunk with rebased weights.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

HIST = 19          # closes kept for the 20-row average
VHIST = 4          # volumes kept for the 5-row volume average
CHUNK = 1000       # rows per rebased RSI chunk


@dataclass
class SymbolState:
    n: int = 0                      # rows processed
    last_close: float | None = None
    gs: float = 0.0                 # decayed gain sum, current-row units
    ls: float = 0.0                 # decayed loss sum
    nd: int = 0                     # number of close differences seen
    spv: int = 0                    # sum(cents * volume)
    sv: int = 0                     # sum(volume)
    closes: list = field(default_factory=list)   # last HIST closes (cents)
    vols: list = field(default_factory=list)     # last VHIST volumes, None where missing


def _rint(x):
    return np.rint(x)


def _rolling_sum(a: np.ndarray, k: int, start: int) -> np.ndarray:
    """Sums of the ``k`` values ending at each index >= start (integers, exact)."""
    zero = np.zeros(1, dtype=a.dtype)
    cs = np.concatenate([zero, np.cumsum(a)])
    idx = np.arange(start, len(a))
    lo = np.maximum(idx + 1 - k, 0)
    return cs[idx + 1] - cs[lo]


def _rolling_count(n_total: int, k: int, start: int) -> np.ndarray:
    idx = np.arange(start, n_total)
    return np.minimum(idx + 1, k)


def _floats(a: np.ndarray) -> np.ndarray:
    """Python integers of any size -> nearest doubles."""
    return np.array([float(x) for x in a], dtype=np.float64)


def advance(st: SymbolState, open_: np.ndarray, close: np.ndarray, volume: np.ndarray,
            periods: int = 14, has_volume: np.ndarray | None = None) -> dict:
    """Indicators for the next rows of one symbol; updates ``st`` in place.

    A missing open (NaN) gives no change; a row without a volume
    (``has_volume`` false) counts in no volume sum and has no volume trend
    and no VWAP.  Sums of price*volume and of squares are Python integers, so
    they can't overflow.
    """
    m = len(close)
    cc = np.round(close * 100.0).astype(np.int64)
    has_open = ~np.isnan(open_)
    oc = np.round(np.where(has_open, open_, 0.0) * 100.0).astype(np.int64)
    mask = np.ones(m, dtype=bool) if has_volume is None else has_volume
    vol = np.where(mask, volume, 0).astype(np.int64)

    h = np.array(st.closes, dtype=np.int64)
    allc = np.concatenate([h, cc])
    s5 = _rolling_sum(allc, 5, len(h))
    k5 = np.minimum(_rolling_count(len(allc), 5, len(h)), st.n + np.arange(1, m + 1))
    s20 = _rolling_sum(allc, 20, len(h))
    k20 = np.minimum(_rolling_count(len(allc), 20, len(h)), st.n + np.arange(1, m + 1))
    wide = allc.astype(object)
    q5 = _rolling_sum(wide * wide, 5, len(h))

    ma5 = _rint(s5.astype(np.float64) / k5.astype(np.float64)) / 100.0
    ma20 = _rint(s20.astype(np.float64) / k20.astype(np.float64)) / 100.0
    with np.errstate(invalid="ignore", divide="ignore"):
        num = _floats(k5 * q5 - s5.astype(object) * s5.astype(object))
        den = (k5 * (k5 - 1)).astype(np.float64)
        vola = np.where(k5 >= 2, _rint(np.sqrt(num / den) / 100.0 * 10000.0) / 10000.0, np.nan)

    hv = np.array([v or 0 for v in st.vols], dtype=np.int64)
    hm = np.array([v is not None for v in st.vols], dtype=bool)
    allv, allm = np.concatenate([hv, vol]), np.concatenate([hm, mask])
    sv5 = _rolling_sum(allv, 5, len(hv))
    kv5 = _rolling_sum(allm.astype(np.int64), 5, len(hv))
    with np.errstate(invalid="ignore", divide="ignore"):
        vtrend = np.where(mask & (sv5 != 0), _rint((vol * kv5).astype(np.float64) / sv5.astype(np.float64)
                                          * 1000.0) / 1000.0, np.nan)

    cpv = st.spv + np.cumsum(cc.astype(object) * vol.astype(object))
    cv = st.sv + np.cumsum(vol.astype(object))
    with np.errstate(invalid="ignore", divide="ignore"):
        vwap = np.where(mask & (cv != 0), _rint(_floats(cpv) / _floats(cv)) / 100.0, np.nan)
        pct = np.where(has_open & (oc != 0), _rint(((cc - oc) * 10000).astype(np.float64) / oc.astype(np.float64))
                       / 100.0, np.nan)

    # RSI: differences of close (the first row of a symbol has none)
    prev = np.concatenate([[np.nan if st.last_close is None else st.last_close], close[:-1]])
    d = close - prev
    has = ~np.isnan(d)
    g = np.where(has, np.maximum(d, 0.0), 0.0)
    lo = np.where(has, np.maximum(-d, 0.0), 0.0)
    q = 1.0 - 1.0 / periods
    gs_out = np.empty(m)
    ls_out = np.empty(m)
    gs, ls = st.gs, st.ls
    for a in range(0, m, CHUNK):
        b = min(m, a + CHUNK)
        j = np.arange(1, b - a + 1, dtype=np.float64)
        up = np.power(1.0 / q, j)              # weights relative to the chunk start
        dec = np.power(q, j)
        gs_out[a:b] = dec * (gs + np.cumsum(g[a:b] * up))
        ls_out[a:b] = dec * (ls + np.cumsum(lo[a:b] * up))
        gs, ls = gs_out[b - 1], ls_out[b - 1]
    nd = st.nd + np.cumsum(has.astype(np.int64))
    with np.errstate(invalid="ignore", divide="ignore"):
        rs = gs_out / ls_out
        rsi = np.where((nd >= periods) & (ls_out > 0), _rint((100.0 - 100.0 / (1.0 + rs)) * 100.0) / 100.0,
                       np.nan)

    st.n += m
    st.last_close = float(close[-1]) if m else st.last_close
    st.gs, st.ls, st.nd = float(gs), float(ls), int(nd[-1]) if m else st.nd
    st.spv, st.sv = int(cpv[-1]) if m else st.spv, int(cv[-1]) if m else st.sv
    st.closes = [int(x) for x in allc[-HIST:]]
    st.vols = [int(x) if k else None for x, k in zip(allv[-VHIST:], allm[-VHIST:], strict=True)]
    return {"moving_avg_5": ma5, "moving_avg_20": ma20, "volatility": vola, "rsi_14": rsi,
            "vwap": vwap, "volume_trend": vtrend, "price_change_pct": pct}
