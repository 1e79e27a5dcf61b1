"""DuckDB SQL for every catalogued query (the correctness oracle).

The SQL restates each query from the driver tables with plain window
functions and aggregates.  Rounding is numpy's (``round_even``) and
prices are summed as integer cents, exactly as the Spark builders do.
"""

from __future__ import annotations

from tickwise.schema import ENRICHED_TICK, EXPECTED_ANALYTICS_COLS

# T1: ticks from events (see tickwise.sources.adapters.ticks_from_events)
TICKS = """
ticks_base AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'S' || CAST(user_id % 6 AS VARCHAR) END AS sector,
         ts AS event_time, event_id AS seq, value AS close,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume,
         CASE WHEN event_type = 'error' THEN 'simulated' ELSE 'real' END AS data_type,
         epoch_us(ts) // 1000 AS ms
  FROM events
),
ticks AS (
  SELECT symbol, sector, event_time, seq, close, volume, data_type,
         COALESCE(LAG(close) OVER (PARTITION BY symbol ORDER BY event_time, seq), close) AS open,
         CASE WHEN volume % 10 = 0 THEN NULL ELSE ms END AS kafka_produce_time,
         ms + 5 + 3 * volume AS spark_process_time,
         strftime(event_time, '%Y-%m-%d %H:%M:%S') AS timestamp,
         CAST(event_time AS DATE) AS date
  FROM ticks_base
)"""

ENRICHED = TICKS + """,
enr0 AS (
  SELECT *, GREATEST(open, close) AS high, LEAST(open, close) AS low,
         CAST(ROUND(close * 100) AS BIGINT) AS cc,
         CAST(ROUND(open * 100) AS BIGINT) AS oc,
         ROW_NUMBER() OVER w AS rn,
         close - LAG(close) OVER w AS d
  FROM ticks
  WINDOW w AS (PARTITION BY symbol ORDER BY event_time, seq)
),
enr1 AS (
  SELECT *,
    CASE WHEN d IS NOT NULL THEN GREATEST(d, 0) END AS g,
    CASE WHEN d IS NOT NULL THEN GREATEST(-d, 0) END AS l,
    POW(CAST(14 AS DOUBLE) / 13, CAST(rn AS DOUBLE)) AS wt,
    COUNT(cc) OVER w5 AS k5, SUM(cc) OVER w5 AS s5, SUM(cc * cc) OVER w5 AS q5,
    COUNT(cc) OVER w20 AS k20, SUM(cc) OVER w20 AS s20,
    SUM(cc * volume) OVER wr AS spv, SUM(volume) OVER wr AS sv,
    COUNT(volume) OVER w5 AS kv5, SUM(volume) OVER w5 AS sv5
  FROM enr0
  WINDOW w5 AS (PARTITION BY symbol ORDER BY event_time, seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         w20 AS (PARTITION BY symbol ORDER BY event_time, seq ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         wr AS (PARTITION BY symbol ORDER BY event_time, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
enr2 AS (
  SELECT *,
    SUM(g * wt) OVER wr AS gs, SUM(l * wt) OVER wr AS ls, COUNT(g) OVER wr AS nd
  FROM enr1
  WINDOW wr AS (PARTITION BY symbol ORDER BY event_time, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
enr3 AS (
  SELECT symbol, sector, open, high, low, close, volume, event_time, kafka_produce_time,
    data_type, timestamp, seq, date, spark_process_time,
    round_even(CAST(s5 AS DOUBLE) / NULLIF(CAST(k5 AS DOUBLE), 0), 0) / 100 AS moving_avg_5,
    round_even(CAST(s20 AS DOUBLE) / NULLIF(CAST(k20 AS DOUBLE), 0), 0) / 100 AS moving_avg_20,
    CASE WHEN k5 >= 2 THEN round_even(SQRT(CAST(k5 * q5 - s5 * s5 AS DOUBLE)
         / CAST(k5 * (k5 - 1) AS DOUBLE)) / 100 * 10000, 0) / 10000 END AS volatility,
    CASE WHEN nd >= 14 AND ls > 0 THEN round_even((100 - 100 / (1 + gs / ls)) * 100, 0) / 100 END AS rsi_14,
    CASE WHEN volume IS NOT NULL
         THEN round_even(CAST(spv AS DOUBLE) / NULLIF(CAST(sv AS DOUBLE), 0), 0) / 100 END AS vwap,
    round_even(CAST(volume * kv5 AS DOUBLE) / NULLIF(CAST(sv5 AS DOUBLE), 0) * 1000, 0) / 1000 AS volume_trend,
    round_even(CAST((cc - oc) * 10000 AS DOUBLE) / NULLIF(CAST(oc AS DOUBLE), 0), 0) / 100 AS price_change_pct
  FROM enr2
),
enriched AS (
  SELECT *,
    COALESCE(price_change_pct < -2 AND volume_trend > 2 AND COALESCE(volatility, 0) > 1.5, FALSE) AS crash_score,
    spark_process_time - COALESCE(kafka_produce_time, spark_process_time) AS latency_ms
  FROM enr3
)"""

ENRICHED_COLS = ("symbol, sector, open, high, low, close, volume, event_time, kafka_produce_time, "
                 "data_type, timestamp, seq, moving_avg_5, moving_avg_20, volatility, rsi_14, vwap, "
                 "volume_trend, price_change_pct, crash_score, spark_process_time, latency_ms, date")


def with_enriched(body: str) -> str:
    return "WITH " + ENRICHED + "\n" + body


SQL: dict[str, str] = {}

SQL["enrich_ticks"] = with_enriched(f"SELECT {ENRICHED_COLS} FROM enriched")

_COLS = [c.strip() for c in ENRICHED_COLS.split(",")]
KEY = "symbol, event_time, seq"

DASH = ENRICHED + """,
dash AS (SELECT * REPLACE (COALESCE(sector, 'Unknown') AS sector) FROM enriched)"""

LATEST = DASH + """,
latest AS (
  SELECT symbol, """ + ",\n    ".join(
    f"arg_max({c}, (event_time, seq)) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in _COLS if c != "symbol") + """
  FROM dash GROUP BY symbol
)"""


def with_dash(body: str) -> str:
    return "WITH " + DASH + "\n" + body


def with_latest(body: str) -> str:
    return "WITH " + LATEST + "\n" + body


def with_ticks(body: str) -> str:
    return "WITH " + TICKS + "\n" + body


# ---- single indicators ------------------------------------------------------
for _c in ("moving_avg_5", "moving_avg_20", "volatility", "vwap", "volume_trend",
           "price_change_pct", "rsi_14"):
    SQL[_c] = with_enriched(f"SELECT {KEY}, {_c} FROM enriched")

SQL["crash_flag"] = with_enriched(
    f"SELECT {KEY}, price_change_pct, volume_trend, volatility, crash_score FROM enriched")
SQL["latency_ms"] = with_enriched(
    f"SELECT {KEY}, kafka_produce_time, spark_process_time, latency_ms FROM enriched")

# ---- snapshot views ---------------------------------------------------------
SQL["latest_per_symbol"] = with_latest(f"SELECT {ENRICHED_COLS} FROM latest")
SQL["latest_row_per_symbol"] = with_dash(
    f"SELECT {ENRICHED_COLS} FROM dash QUALIFY ROW_NUMBER() OVER "
    "(PARTITION BY symbol ORDER BY event_time DESC, seq DESC) = 1")
SQL["tail_per_symbol"] = with_dash(
    "SELECT symbol, close, price_change_pct, rsi_14, vwap, crash_score, data_type, event_time, "
    "pos_from_end FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY event_time DESC, "
    "seq DESC) AS pos_from_end FROM dash) WHERE pos_from_end <= 3")
SQL["state_snapshot"] = with_enriched(
    f"SELECT {ENRICHED_COLS} FROM enriched QUALIFY ROW_NUMBER() OVER "
    "(PARTITION BY symbol ORDER BY event_time DESC, seq DESC) <= 50")
SQL["recent_window"] = with_dash(
    f"SELECT {KEY}, close, sector FROM dash "
    "WHERE event_time >= (SELECT MAX(event_time) FROM dash) - INTERVAL 60 MINUTE")
SQL["filter_sector_symbol"] = with_dash(
    f"SELECT {KEY}, sector, close FROM dash WHERE sector IN ('S1', 'S3')")
SQL["filter_symbols"] = with_dash(
    f"SELECT {KEY}, sector, close, rsi_14 FROM dash WHERE symbol IN ('U1', 'U8', 'U42')")
SQL["symbol_series"] = with_dash(
    f"SELECT {KEY}, close, high, low, volume, moving_avg_5, moving_avg_20, vwap "
    "FROM dash WHERE symbol = 'U8'")
SQL["market_kpis"] = with_dash(
    "SELECT COUNT(DISTINCT symbol) AS symbols, COUNT(*) AS total_events, "
    "AVG(latency_ms) AS avg_latency_ms, COUNT(*) FILTER (WHERE crash_score) AS crash_signals FROM dash")
SQL["market_snapshot"] = with_latest(
    "SELECT symbol, sector, close, price_change_pct, volatility, moving_avg_5, volume, data_type FROM latest")
SQL["sector_performance"] = with_latest(
    "SELECT sector, AVG(price_change_pct) AS avg_price_change_pct FROM latest GROUP BY sector")
SQL["top_gainers"] = with_latest(
    "SELECT symbol, close, price_change_pct FROM latest WHERE price_change_pct IS NOT NULL "
    "ORDER BY price_change_pct DESC, symbol LIMIT 5")
SQL["top_losers"] = with_latest(
    "SELECT symbol, close, price_change_pct FROM latest WHERE price_change_pct IS NOT NULL "
    "ORDER BY price_change_pct ASC, symbol LIMIT 5")
SQL["change_sign"] = with_latest(
    "SELECT symbol, price_change_pct, CASE WHEN price_change_pct > 0 THEN 'up' "
    "WHEN price_change_pct < 0 THEN 'down' WHEN price_change_pct = 0 THEN 'flat' END AS change_sign "
    "FROM latest")
SQL["crash_summary"] = with_dash(
    "SELECT COUNT(*) FILTER (WHERE crash_score) AS total_crashes, "
    "COUNT(DISTINCT symbol) FILTER (WHERE crash_score) AS affected_symbols, "
    "MIN(price_change_pct) FILTER (WHERE crash_score) AS worst_drop_pct FROM dash")
SQL["crash_history"] = with_dash(
    "SELECT event_time, symbol, sector, close, price_change_pct, volume_trend, volatility, seq "
    "FROM dash WHERE crash_score ORDER BY event_time DESC, seq DESC LIMIT 50")
SQL["crash_timeline"] = with_dash(
    f"SELECT {KEY}, price_change_pct FROM dash WHERE crash_score")
SQL["distinct_symbols"] = with_dash(
    "SELECT DISTINCT sector, symbol FROM dash WHERE symbol IS NOT NULL")
SQL["sector_default"] = with_ticks(
    f"SELECT {KEY}, COALESCE(sector, 'Unknown') AS sector FROM ticks")

# ---- signals ------------------------------------------------------------------
SQL["ma_divergence"] = with_dash(
    f"SELECT {KEY}, ma_div_pct, CASE WHEN ma_div_pct >= 0 THEN 'bullish' ELSE 'bearish' END AS signal "
    "FROM (SELECT *, (moving_avg_5 - moving_avg_20) / NULLIF(moving_avg_20, 0) * 100 AS ma_div_pct "
    "FROM dash) WHERE ma_div_pct IS NOT NULL")
SQL["vwap_deviation"] = with_latest(
    "SELECT symbol, sector, rsi_14, (close - vwap) / vwap * 100 AS vwap_dev_pct, "
    "CASE WHEN rsi_14 < 30 THEN 'oversold' WHEN rsi_14 > 70 THEN 'overbought' ELSE 'neutral' END "
    "AS rsi_zone FROM latest WHERE rsi_14 IS NOT NULL AND vwap IS NOT NULL AND close IS NOT NULL "
    "AND vwap > 0")
_RECENT500 = "(SELECT * FROM dash ORDER BY event_time DESC, seq DESC LIMIT 500)"
SQL["risk_cube"] = with_dash(
    f"SELECT {KEY}, volatility, rsi_14, LN(1 + volume) AS log_volume, price_change_pct "
    f"FROM {_RECENT500} WHERE volatility IS NOT NULL AND rsi_14 IS NOT NULL AND volume IS NOT NULL "
    "AND price_change_pct IS NOT NULL")
SQL["anomaly_split"] = with_latest(
    "SELECT symbol, volume_trend, price_change_pct, COALESCE(crash_score, FALSE) AS is_crash, "
    "LEAST(GREATEST(COALESCE(volatility, 0.5) * 80 + 30, 20), 200) AS point_size FROM latest "
    "WHERE volume_trend IS NOT NULL AND price_change_pct IS NOT NULL")
SQL["price_volume_time"] = with_dash(
    f"SELECT {KEY}, close, volume, "
    "CAST(epoch_us(event_time) - epoch_us(MIN(event_time) OVER ()) AS DOUBLE) / 1e6 AS t_seconds, "
    f"DENSE_RANK() OVER (ORDER BY symbol) - 1 AS symbol_ordinal FROM {_RECENT500}")
SQL["recent_rows"] = with_dash(f"SELECT {KEY}, close, volume FROM {_RECENT500}")
SQL["elapsed_seconds"] = with_ticks(
    f"SELECT {KEY}, CAST(epoch_us(event_time) - epoch_us(MIN(event_time) OVER ()) AS DOUBLE) / 1e6 "
    "AS elapsed_s FROM ticks")
SQL["symbol_ordinal"] = with_ticks(
    "SELECT symbol, DENSE_RANK() OVER (ORDER BY symbol) - 1 AS symbol_ordinal "
    "FROM (SELECT DISTINCT symbol FROM ticks WHERE symbol IS NOT NULL)")

# ---- correlation and time series --------------------------------------------
BRAND_TICKS = """brand_ticks AS (
  SELECT p_brand AS symbol, l_shipdate AS event_time,
         l_extendedprice / NULLIF(l_quantity, 0) AS close, CAST(l_quantity AS BIGINT) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""
_BRANDS = [f"Brand#{i}" for i in range(1, 26)]
SQL["price_pivot"] = ("WITH " + BRAND_TICKS + "\nSELECT event_time, " + ", ".join(
    f"AVG(close) FILTER (WHERE symbol = '{b}') AS \"{b}\"" for b in _BRANDS)
    + " FROM brand_ticks GROUP BY event_time")


def _corr(points_cte: str, where: str = "") -> str:
    return "WITH " + points_cte + """,
pts AS (SELECT event_time, symbol, AVG(close) AS v FROM src WHERE close IS NOT NULL """ + where + """
        GROUP BY event_time, symbol),
gate AS (SELECT COUNT(DISTINCT event_time) AS n_periods, COUNT(DISTINCT symbol) AS n_symbols FROM pts),
pairs AS (
  SELECT a.symbol AS symbol_a, b.symbol AS symbol_b,
         round_even(CASE WHEN isnan(CORR(a.v, b.v)) THEN NULL ELSE CORR(a.v, b.v) END * 1000000, 0)
         / 1000000 AS corr, COUNT(*) AS n_common
  FROM pts a JOIN pts b ON a.event_time = b.event_time AND a.symbol <= b.symbol
  GROUP BY a.symbol, b.symbol),
defined AS (SELECT symbol_a AS s FROM pairs WHERE corr IS NOT NULL
            UNION SELECT symbol_b FROM pairs WHERE corr IS NOT NULL)
SELECT symbol_a, symbol_b, corr, n_common FROM pairs, gate
WHERE symbol_a IN (SELECT s FROM defined) AND symbol_b IN (SELECT s FROM defined)
  AND n_periods >= 20 AND n_symbols >= 10"""


SQL["corr_matrix"] = _corr(BRAND_TICKS + ", src AS (SELECT * FROM brand_ticks)")
SQL["corr_matrix_ticks"] = _corr(
    TICKS + ", src AS (SELECT symbol, date_trunc('hour', event_time) AS event_time, close FROM ticks)")
SQL["growth_per_minute"] = with_dash("""
, per_min AS (SELECT date_trunc('minute', event_time) AS minute, COUNT(*) AS n FROM dash GROUP BY 1),
spine AS (SELECT UNNEST(generate_series(MIN(minute), MAX(minute), INTERVAL 1 MINUTE)) AS minute FROM per_min)
SELECT s.minute, COALESCE(p.n, 0) AS count,
       CAST(SUM(COALESCE(p.n, 0)) OVER (ORDER BY s.minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS cumulative
FROM spine s LEFT JOIN per_min p ON s.minute = p.minute""".replace("\n, per_min", ", per_min", 1))

# ---- metrics and quality ------------------------------------------------------
SQL["rows_per_symbol"] = with_dash("SELECT symbol, COUNT(*) AS rows FROM dash GROUP BY symbol")
SQL["latency_stats"] = with_dash(
    "SELECT AVG(CAST(latency_ms AS DOUBLE)) AS avg_ms, "
    "QUANTILE_CONT(CAST(latency_ms AS DOUBLE), 0.95) AS p95_ms, COUNT(*) AS n "
    "FROM dash WHERE latency_ms IS NOT NULL")
SQL["latency_histogram"] = with_dash("""
, x AS (SELECT CAST(latency_ms AS DOUBLE) AS x FROM dash WHERE latency_ms IS NOT NULL),
rng AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM x),
binned AS (
  SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR((x - lo) / (hi - lo) * 30.0), 29) END AS INTEGER)
         AS bin, COUNT(*) AS n
  FROM x, rng GROUP BY 1),
spine AS (SELECT lo, hi, CAST(UNNEST(generate_series(0, CASE WHEN hi = lo THEN 0 ELSE 29 END)) AS INTEGER) AS bin FROM rng)
SELECT s.bin, lo + s.bin * ((hi - lo) / 30.0) AS bin_lo, lo + (s.bin + 1) * ((hi - lo) / 30.0) AS bin_hi,
       COALESCE(b.n, 0) AS count
FROM spine s LEFT JOIN binned b ON s.bin = b.bin""".replace("\n, x AS", ", x AS", 1))
SQL["data_type_breakdown"] = with_dash(
    "SELECT data_type, n, n / SUM(n) OVER () AS share FROM "
    "(SELECT data_type, COUNT(*) AS n FROM dash WHERE data_type IS NOT NULL GROUP BY data_type)")
SQL["partition_listing"] = with_enriched(
    "SELECT date, COUNT(*) AS rows, COUNT(DISTINCT symbol) AS symbols FROM enriched GROUP BY date")

WORKERS = """workers AS (
  SELECT ts AS timestamp, CAST(user_id % 4 AS INTEGER) AS worker_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS messages_sent,
         CAST(TRUNC(value * 10) AS BIGINT) AS queue_depth, event_id AS seq
  FROM events)"""
BATCHES = """batches AS (
  SELECT event_id // 100 AS batch_id, COUNT(*) AS total_rows, SUM(value) AS elapsed_ms,
         MAX(ts) AS timestamp
  FROM events GROUP BY 1)"""
SQL["worker_throughput"] = ("WITH " + WORKERS + "\nSELECT worker_id, CAST(SUM(messages_sent) AS BIGINT) AS messages_sent "
                            "FROM (SELECT * FROM workers ORDER BY timestamp DESC, seq DESC LIMIT 40) "
                            "GROUP BY worker_id")
SQL["queue_depth_alerts"] = ("WITH " + WORKERS + "\nSELECT timestamp, worker_id, queue_depth FROM workers "
                             "WHERE queue_depth > 1000")
SQL["queue_depth_recent"] = ("WITH " + WORKERS + "\nSELECT timestamp, worker_id, queue_depth, "
                             "queue_depth > 1000 AS above_threshold FROM workers "
                             "ORDER BY timestamp DESC, seq DESC LIMIT 100")
SQL["stream_throughput"] = ("WITH " + BATCHES + "\nSELECT AVG(total_rows) AS avg_rows_per_batch, "
                            "AVG(total_rows) / 10.0 AS rows_per_sec FROM "
                            "(SELECT * FROM batches ORDER BY batch_id DESC LIMIT 6)")
SQL["batch_duration"] = ("WITH " + BATCHES + "\nSELECT AVG(elapsed_ms) AS avg_batch_ms, "
                         "COUNT(*) AS batches FROM batches")
SQL["batch_metrics"] = with_ticks("""
SELECT batch_id, CAST(SUM(n) AS BIGINT) AS total_rows,
       CAST(to_json(map_from_entries(list(struct_pack(symbol := symbol, n := n) ORDER BY symbol, n))) AS VARCHAR)
       AS per_symbol
FROM (SELECT seq // 100 AS batch_id, symbol, COUNT(*) AS n FROM ticks GROUP BY 1, 2)
GROUP BY batch_id""")

# ---- schema-level checks ------------------------------------------------------

SQL["completeness_check"] = with_enriched(
    "SELECT column_name, present, (SELECT COUNT(*) FROM enriched) AS total_rows FROM (VALUES "
    + ", ".join(f"('{c}', {'TRUE' if c in _COLS else 'FALSE'})" for c in EXPECTED_ANALYTICS_COLS)
    + ") AS t(column_name, present)")

SQL["schema_profile"] = with_enriched("\nUNION ALL\n".join(
    f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS dtype, "
    f"COUNT({f.name}) AS non_null, "
    f"CAST(arg_max_null({f.name}, (event_time, seq)) AS VARCHAR) AS sample FROM enriched"
    for f in ENRICHED_TICK.fields))

# ---- sources, sinks and projections -------------------------------------------
_MSG = ("symbol", "sector", "open", "high", "low", "close", "volume", "timestamp",
        "kafka_produce_time", "data_type")
RAW_COLS = ("symbol, sector, open, GREATEST(open, close) AS high, LEAST(open, close) AS low, close, "
            "volume, event_time, kafka_produce_time, data_type, date")

SQL["json_encode"] = with_ticks(
    "SELECT symbol AS key, CAST(to_json(struct_pack(" + ", ".join(
        f"{c} := {'GREATEST(open, close)' if c == 'high' else 'LEAST(open, close)' if c == 'low' else c}"
        for c in _MSG) + ")) AS VARCHAR) AS value, seq FROM ticks")
SQL["json_decode"] = with_ticks(
    "SELECT seq, symbol, sector, open, GREATEST(open, close) AS high, LEAST(open, close) AS low, close, "
    "volume, timestamp, kafka_produce_time, data_type, "
    "CAST(strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS event_time, "
    "CAST(strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS DATE) AS date, "
    "CAST(NULL AS VARCHAR) AS quarantine FROM ticks")
SQL["event_time_parse"] = with_ticks(
    "SELECT symbol, seq, timestamp, CAST(strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) "
    "AS event_time_parsed FROM ticks")
SQL["event_date"] = with_ticks(f"SELECT {KEY}, COALESCE(date, CAST(event_time AS DATE)) AS date FROM ticks")
SQL["legacy_alias"] = with_ticks(
    "SELECT symbol, seq, timestamp, close, CAST(strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) "
    "AS event_time FROM ticks")
SQL["sector_lookup"] = """
SELECT o_orderkey, o_custkey, COALESCE(r_name, 'Unknown') AS sector, o_totalprice
FROM orders LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey
                                JOIN region ON n_regionkey = r_regionkey) ON o_custkey = c_custkey"""
SQL["union_history"] = with_enriched(f"""
SELECT {KEY}, close, moving_avg_5, CAST(NULL AS BIGINT) AS volume FROM enriched WHERE date < DATE '2024-01-15'
UNION ALL
SELECT {KEY}, close, CAST(NULL AS DOUBLE) AS moving_avg_5, volume FROM enriched WHERE date >= DATE '2024-01-15'""")
SQL["sink_raw_roundtrip"] = with_ticks(f"SELECT {RAW_COLS} FROM ticks")
SQL["sink_enriched_roundtrip"] = with_enriched(f"SELECT {ENRICHED_COLS} FROM enriched")
SQL["scan_enriched"] = with_dash(
    f"SELECT {KEY}, sector, close, rsi_14, date FROM dash "
    "WHERE symbol IN ('U1', 'U2', 'U3', 'U50') AND date >= DATE '2024-01-10'")
SQL["scan_raw"] = with_ticks(
    "SELECT date, COUNT(*) AS rows, CAST(SUM(volume) AS BIGINT) AS volume FROM ticks GROUP BY date")
SQL["scan_worker_metrics"] = ("WITH " + WORKERS +
                              "\nSELECT timestamp, worker_id, messages_sent, queue_depth FROM workers")
SQL["scan_batch_metrics"] = with_ticks(
    "SELECT seq // 100 AS batch_id, symbol, COUNT(*) AS rows FROM ticks GROUP BY 1, 2")
SQL["state_bootstrap"] = SQL["state_snapshot"]

# ---- streaming ------------------------------------------------------------------
SQL["stream_enrich"] = SQL["enrich_ticks"]
SQL["stream_restart"] = SQL["enrich_ticks"]
SQL["stream_compaction"] = SQL["enrich_ticks"]
SQL["stream_batch_metrics"] = with_ticks("SELECT symbol, COUNT(*) AS rows FROM ticks GROUP BY symbol")
SQL["stream_minute_counts"] = with_ticks(
    "SELECT date_trunc('minute', event_time) AS minute, COUNT(*) AS count FROM ticks GROUP BY 1")
SQL["stream_source_file"] = SQL["json_decode"].replace(
    ", CAST(NULL AS VARCHAR) AS quarantine FROM ticks", " FROM ticks")
SQL["stream_late_rows"] = with_ticks(
    "SELECT symbol, event_time, seq + 1000000000000 AS seq, close FROM ticks t "
    "WHERE date = (SELECT MIN(date) FROM ticks) "
    "AND event_time < (SELECT MAX(event_time) FROM ticks u WHERE u.symbol = t.symbol)")
SQL["enrich_split"] = SQL["enrich_ticks"]
SQL["dedup_ticks"] = """
WITH t AS (
  SELECT p_brand AS symbol, l_shipdate AS event_time, l_extendedprice / NULLIF(l_quantity, 0) AS close,
         CAST(l_quantity AS BIGINT) AS volume, l_orderkey * 10 + l_linenumber AS seq, l_suppkey AS supplier
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT symbol, event_time, close AS open, close AS high, close AS low, close, volume,
       MIN(seq) AS seq, arg_min(supplier, seq) AS supplier
FROM t GROUP BY symbol, event_time, close, volume"""
SQL["scan_recent"] = with_dash(
    f"SELECT {KEY}, sector, close, vwap FROM dash "
    "WHERE event_time >= (SELECT MAX(event_time) FROM dash) - INTERVAL 1440 MINUTE")
SQL["distinct_sectors"] = with_dash("SELECT DISTINCT sector FROM dash WHERE sector IS NOT NULL")
SQL["display_names"] = with_latest(
    "SELECT " + ", ".join(f'{c} AS "{c.replace("_", " ").title()}"' for c in (
        "symbol", "sector", "close", "price_change_pct", "volatility", "moving_avg_5", "volume", "data_type"))
    + " FROM latest")
SQL["symbol_codes"] = with_ticks(
    f"SELECT {KEY}, DENSE_RANK() OVER (ORDER BY symbol) - 1 AS symbol_ordinal FROM ticks")
_TICK_COLS = ("symbol", "sector", "event_time", "seq", "close", "volume", "data_type", "open", "high", "low",
              "kafka_produce_time", "spark_process_time", "timestamp", "date")
SQL["completeness_absent"] = with_ticks(
    "SELECT column_name, present, (SELECT COUNT(*) FROM ticks) AS total_rows FROM (VALUES "
    + ", ".join(f"('{c}', {'TRUE' if c in _TICK_COLS else 'FALSE'})" for c in EXPECTED_ANALYTICS_COLS)
    + ") AS t(column_name, present)")
_DIFF = ([(c, "missing") for c in EXPECTED_ANALYTICS_COLS if c not in _TICK_COLS]
         + [(c, "unexpected") for c in _TICK_COLS if c not in EXPECTED_ANALYTICS_COLS])
SQL["column_differences"] = "SELECT * FROM (VALUES " + ", ".join(map(str, _DIFF)) + ") AS t(column_name, difference)"
SQL["enrich_hot"] = SQL["enrich_ticks"]
# missing volumes and opens: the prices behind them stay
_GAPS = with_enriched(f"SELECT {ENRICHED_COLS} FROM enriched").replace(
    "enr0 AS (\n  SELECT *,", "enr0 AS (\n  SELECT * REPLACE (CASE WHEN seq % 7 <> 0 THEN volume END AS volume, "
    "CASE WHEN seq % 11 <> 0 THEN open END AS open),").replace(
    "CAST(ROUND(open * 100) AS BIGINT) AS oc", "CASE WHEN seq % 11 <> 0 THEN CAST(ROUND(open * 100) AS BIGINT) END AS oc")
SQL["enrich_gaps"] = SQL["stream_gaps"] = _GAPS
_BROKEN = ("CASE WHEN seq % 13 = 0 THEN 'malformed_json' WHEN seq % 17 = 0 THEN 'future_timestamp' "
           "WHEN seq % 19 = 0 THEN 'null_symbol' END")
SQL["stream_quarantine"] = with_ticks(
    f"SELECT {_BROKEN} AS quarantine, COUNT(*) AS rows FROM ticks WHERE {_BROKEN} IS NOT NULL GROUP BY 1")
SQL["stream_raw_archive"] = with_ticks(
    "SELECT CASE WHEN seq % 13 = 0 OR (seq % 19 = 0 AND seq % 17 <> 0) THEN NULL ELSE symbol END AS symbol, "
    "COUNT(*) AS rows FROM ticks GROUP BY 1")


# ---- the stream with its state in tables, trailing indicators ------------------

for _name in ("stream_carried", "stream_late_merged"):
    SQL[_name] = SQL["enrich_ticks"]
SQL["stream_warm_start"] = with_enriched(f"""
SELECT {ENRICHED_COLS} FROM enriched WHERE date IN (
  SELECT date FROM (SELECT date, percent_rank() OVER (ORDER BY date) AS p FROM (SELECT DISTINCT date FROM ticks))
  WHERE LEAST(FLOOR(p * 3), 2) = 2)""")
SQL["stream_hot"] = SQL["enrich_ticks"].replace(
    "'U' || CAST(user_id AS VARCHAR) AS symbol",
    "CASE WHEN event_id % 2 = 0 THEN 'HOT' ELSE 'U' || CAST(user_id AS VARCHAR) END AS symbol")
SQL["stream_growth"] = SQL["growth_per_minute"]
SQL["stream_batch_rows"] = SQL["stream_batch_metrics"]
SQL["state_export"] = SQL["state_snapshot"]

_GOOD = "seq % 13 <> 0 AND seq % 17 <> 0 AND seq % 19 <> 0"
SQL["stream_ingest"] = with_enriched(
    f"SELECT {KEY}, close, volume, moving_avg_5, moving_avg_20, volatility, rsi_14, vwap, volume_trend, "
    "price_change_pct, crash_score FROM enriched").replace(
    "FROM ticks\n  WINDOW w",      # messages carry whole seconds
    f"FROM (SELECT * REPLACE (date_trunc('second', event_time) AS event_time) FROM ticks WHERE {_GOOD}) ticks\n"
    "  WINDOW w")
SQL["stream_ingest_tables"] = with_ticks(f"""
SELECT 'raw' AS name, COUNT(*) AS rows FROM ticks
UNION ALL SELECT 'quarantine', COUNT(*) FROM ticks WHERE NOT ({_GOOD})
UNION ALL SELECT 'enriched', COUNT(*) FROM ticks WHERE {_GOOD}
UNION ALL SELECT 'metrics', COUNT(*) FROM ticks WHERE {_GOOD}""")


def _vwap(frame: str) -> str:
    return with_ticks(f"""
SELECT {KEY}, round_even(CAST(SUM(CAST(ROUND(close * 100) AS BIGINT) * volume) OVER w AS DOUBLE)
         / NULLIF(CAST(SUM(volume) OVER w AS DOUBLE), 0), 0) / 100 AS vwap
FROM ticks WINDOW w AS ({frame})""")


SQL["vwap_daily"] = _vwap("PARTITION BY symbol, date ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING")
SQL["vwap_lookback"] = _vwap("PARTITION BY symbol ORDER BY event_time, seq ROWS 19 PRECEDING")
# every row's frame is gone through: differences of the last 29 rows, weighted by age
SQL["rsi_lookback"] = with_ticks(f"""
, d AS (SELECT *, close - LAG(close) OVER w AS d, ROW_NUMBER() OVER w AS rn FROM ticks
        WINDOW w AS (PARTITION BY symbol ORDER BY event_time, seq)),
f AS (SELECT a.symbol, a.event_time, a.seq, COUNT(b.d) AS n,
             SUM(GREATEST(b.d, 0) * POW(13.0 / 14.0, a.rn - b.rn)) AS g,
             SUM(GREATEST(-b.d, 0) * POW(13.0 / 14.0, a.rn - b.rn)) AS l
      FROM d a LEFT JOIN d b ON b.symbol = a.symbol AND b.rn BETWEEN a.rn - 28 AND a.rn
      GROUP BY a.symbol, a.event_time, a.seq)
SELECT {KEY}, CASE WHEN n >= 14 AND l > 0 THEN round_even((100 - 100 / (1 + g / l)) * 100, 0) / 100 END AS rsi_14 FROM f""")
