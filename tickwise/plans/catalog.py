"""Named queries over the driver tables: ``name -> f(spark, sf_dir)``.

Every query reads whole tables (T1 ticks come from all of ``events``)
and returns a DataFrame whose column names match the oracle SQL in
``tickwise.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.functions import indicators as ind
from tickwise.functions.timefns import parse_event_time
from tickwise.operators import correlation, metrics, quality, snapshot, timeseries, trailing, views
from tickwise.operators.enrich import enrich, symbol_window, usable, with_open
from tickwise.operators.joins import lookup_join
from tickwise.schema import ENRICHED_TICK, RAW_TICK, conform
from tickwise.session import checkpoint_dir
from tickwise.sources import adapters, sinks, tables
from tickwise.sources import ticks as tick_io
from tickwise.sources.adapters import table, ticks_from_events
from tickwise.streaming import carried, growth
from tickwise.streaming import job as stream_job
from tickwise.streaming.stateful import LATE_HORIZON
from tickwise.streaming.windows import minute_counts

ENRICHED_COLS = [f.name for f in ENRICHED_TICK.fields]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def reg(fn):
        QUERIES[name] = fn
        return fn
    return reg


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(table(spark, sf_dir, "events"))


def enriched(spark: SparkSession, sf_dir: str, only=None) -> DataFrame:
    """Every indicator; ``only`` filters symbols before the series are looked at."""
    t = ticks_from_events(table(spark, sf_dir, "events"), with_prices=False)
    if only is not None:
        t = t.where(only)
    return enrich(t, open_from_close=True).select(*ENRICHED_COLS)


@query("enrich_ticks")
def q_enrich_ticks(spark, sf_dir):
    return enriched(spark, sf_dir)


# ---- shared inputs --------------------------------------------------------


def dash(spark, sf_dir):
    """The dashboard's frame: enriched ticks with sector defaulted."""
    return snapshot.sector_default(enriched(spark, sf_dir))


def feed(spark, sf_dir):
    """The same rows for views that need no indicator: no window, no planning job."""
    t = ticks_from_events(table(spark, sf_dir, "events"), with_prices=False)
    return snapshot.sector_default(usable(t)).withColumn(
        "latency_ms", ind.latency_ms(F.col("spark_process_time"), F.col("kafka_produce_time")))


def latest(spark, sf_dir):
    return snapshot.latest_per_symbol(dash(spark, sf_dir))


def worker_metrics(spark, sf_dir):
    return adapters.worker_metrics_from_events(table(spark, sf_dir, "events"))


def batch_table(spark, sf_dir):
    return adapters.batch_metrics_from_events(table(spark, sf_dir, "events"))


def brand_ticks(spark, sf_dir):
    return adapters.ticks_from_lineitem(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))


KEY = ["symbol", "event_time", "seq"]


# ---- single indicators (W1-W7, P6-P8) -------------------------------------

def _indicator(name):
    def run(spark, sf_dir):
        return enriched(spark, sf_dir).select(*KEY, name)
    return run


# each through ``enrich``, so that a hot symbol is split for them, too
for _name in ("moving_avg_5", "moving_avg_20", "volatility", "vwap", "volume_trend", "price_change_pct", "rsi_14"):
    QUERIES[_name] = _indicator(_name)


@query("crash_flag")
def q_crash(spark, sf_dir):
    return enriched(spark, sf_dir).select(*KEY, "price_change_pct", "volume_trend", "volatility",
                                          "crash_score")


@query("latency_ms")
def q_latency(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.select(*KEY, "kafka_produce_time", "spark_process_time",
                    ind.latency_ms(F.col("spark_process_time"), F.col("kafka_produce_time")).alias("latency_ms"))


# ---- snapshot views (W9, W10, F1-F3, A1, A3, L2, A15, L4, D1, D2, D9) ------

@query("latest_per_symbol")
def q_latest(spark, sf_dir):
    return latest(spark, sf_dir).select(*ENRICHED_COLS)


@query("latest_row_per_symbol")
def q_latest_row(spark, sf_dir):
    return snapshot.latest_per_symbol(dash(spark, sf_dir), mode="row").select(*ENRICHED_COLS)


# The columns of the per-symbol tail view, in order.
TAIL_COLS = ["symbol", "close", "price_change_pct", "rsi_14", "vwap", "crash_score",
             "data_type", "event_time"]


@query("tail_per_symbol")
def q_tail(spark, sf_dir):
    return snapshot.tail_per_symbol(dash(spark, sf_dir), 3, columns=TAIL_COLS)


@query("state_snapshot")
def q_state_snapshot(spark, sf_dir):
    return snapshot.tail_per_symbol(enriched(spark, sf_dir), 50).drop("pos_from_end")


@query("recent_window")
def q_recent_window(spark, sf_dir):
    return snapshot.recent_window(feed(spark, sf_dir), 60).select(*KEY, "close", "sector")


@query("filter_sector_symbol")
def q_filter(spark, sf_dir):
    return snapshot.filter_sector_symbol(feed(spark, sf_dir), sectors=["S1", "S3"]).select(
        *KEY, "sector", "close")


@query("filter_symbols")
def q_filter_symbols(spark, sf_dir):
    wanted = ["U1", "U8", "U42"]
    d = snapshot.sector_default(enriched(spark, sf_dir, F.col("symbol").isin(wanted)))
    return snapshot.filter_sector_symbol(d, symbols=wanted).select(*KEY, "sector", "close", "rsi_14")


@query("symbol_series")
def q_symbol_series(spark, sf_dir):
    d = snapshot.sector_default(enriched(spark, sf_dir, F.col("symbol") == "U8"))
    return views.symbol_series(d, "U8")


@query("distinct_sectors")
def q_sectors(spark, sf_dir):
    return views.distinct_sectors(feed(spark, sf_dir))


@query("display_names")
def q_display_names(spark, sf_dir):
    return views.display_names(views.market_snapshot(None, latest(spark, sf_dir)))


@query("market_kpis")
def q_kpis(spark, sf_dir):
    return views.market_kpis(dash(spark, sf_dir))


@query("market_snapshot")
def q_snapshot(spark, sf_dir):
    return views.market_snapshot(None, latest(spark, sf_dir))


@query("sector_performance")
def q_sector_perf(spark, sf_dir):
    return views.sector_performance(None, latest(spark, sf_dir))


@query("top_gainers")
def q_gainers(spark, sf_dir):
    return views.top_movers(None, 5, True, latest(spark, sf_dir))


@query("top_losers")
def q_losers(spark, sf_dir):
    return views.top_movers(None, 5, False, latest(spark, sf_dir))


@query("change_sign")
def q_change_sign(spark, sf_dir):
    return views.change_sign(latest(spark, sf_dir).select("symbol", "price_change_pct"))


@query("crash_summary")
def q_crash_summary(spark, sf_dir):
    return views.crash_summary(dash(spark, sf_dir))


@query("crash_history")
def q_crash_history(spark, sf_dir):
    return views.crash_history(dash(spark, sf_dir), 50)


@query("crash_timeline")
def q_crash_timeline(spark, sf_dir):
    return views.crash_timeline(dash(spark, sf_dir))


@query("distinct_symbols")
def q_distinct(spark, sf_dir):
    return views.distinct_symbols(feed(spark, sf_dir))


@query("sector_default")
def q_sector_default(spark, sf_dir):
    return snapshot.sector_default(ticks(spark, sf_dir)).select(*KEY, "sector")


# ---- signals (P9-P17, D3-D6) -------------------------------------------------

@query("ma_divergence")
def q_ma_div(spark, sf_dir):
    return views.ma_divergence(dash(spark, sf_dir))


@query("vwap_deviation")
def q_vwap_dev(spark, sf_dir):
    return views.vwap_signals(None, latest(spark, sf_dir))


@query("risk_cube")
def q_risk_cube(spark, sf_dir):
    return views.risk_cube(dash(spark, sf_dir), 500)


@query("anomaly_split")
def q_anomaly(spark, sf_dir):
    return views.anomaly_split(None, latest(spark, sf_dir))


@query("price_volume_time")
def q_pvt(spark, sf_dir):
    return views.price_volume_time(feed(spark, sf_dir), 500)


@query("recent_rows")
def q_recent_rows(spark, sf_dir):
    return snapshot.recent_rows(feed(spark, sf_dir), 500).select(*KEY, "close", "volume")


@query("elapsed_seconds")
def q_elapsed(spark, sf_dir):
    return timeseries.elapsed_seconds(ticks(spark, sf_dir)).select(*KEY, "elapsed_s")


@query("symbol_ordinal")
def q_ordinal(spark, sf_dir):
    return timeseries.symbol_ordinal(feed(spark, sf_dir))


@query("symbol_codes")
def q_symbol_codes(spark, sf_dir):
    return timeseries.symbol_codes(feed(spark, sf_dir)).select(*KEY, "symbol_ordinal")


# ---- correlation and time series (A7-A10, J2, F10) --------------------------

@query("price_pivot")
def q_pivot(spark, sf_dir):
    return correlation.price_pivot(brand_ticks(spark, sf_dir))


@query("corr_matrix")
def q_corr(spark, sf_dir):
    return correlation.corr_matrix(brand_ticks(spark, sf_dir))


@query("corr_matrix_ticks")
def q_corr_ticks(spark, sf_dir):
    # ticks aligned on the hour so symbols share periods
    t = feed(spark, sf_dir).withColumn("event_time", F.date_trunc("hour", "event_time"))
    return correlation.corr_matrix(t)


@query("growth_per_minute")
def q_growth(spark, sf_dir):
    return timeseries.growth_per_minute(feed(spark, sf_dir))


# ---- metrics and quality (A2, A4-A6, A11-A14, A16-A19, F8, L3) ---------------

@query("rows_per_symbol")
def q_rows_per_symbol(spark, sf_dir):
    return metrics.rows_per_symbol(feed(spark, sf_dir))


@query("latency_stats")
def q_latency_stats(spark, sf_dir):
    return quality.latency_stats(feed(spark, sf_dir))


@query("latency_histogram")
def q_latency_hist(spark, sf_dir):
    return quality.histogram(feed(spark, sf_dir), "latency_ms", 30)


@query("data_type_breakdown")
def q_breakdown(spark, sf_dir):
    return quality.breakdown(feed(spark, sf_dir), "data_type")


@query("schema_profile")
def q_profile(spark, sf_dir):
    return quality.schema_profile(enriched(spark, sf_dir))


@query("completeness_check")
def q_completeness(spark, sf_dir):
    return quality.completeness_check(enriched(spark, sf_dir))


@query("completeness_absent")
def q_completeness_absent(spark, sf_dir):
    # a feed without indicators lacks most of the expected columns
    return quality.completeness_check(ticks(spark, sf_dir))


@query("column_differences")
def q_column_differences(spark, sf_dir):
    return quality.column_differences(ticks(spark, sf_dir))


@query("partition_listing")
def q_partitions(spark, sf_dir):
    # the partitions of the written table
    path = scratch(spark, "partitions")
    sinks.write_enriched(enriched(spark, sf_dir), path, mode="overwrite")
    return quality.partition_listing(spark.read.schema(ENRICHED_TICK).parquet(path), ["date"])


@query("worker_throughput")
def q_worker_tp(spark, sf_dir):
    return metrics.worker_throughput(worker_metrics(spark, sf_dir), 40)


@query("queue_depth_alerts")
def q_qd_alerts(spark, sf_dir):
    return metrics.queue_depth_alerts(worker_metrics(spark, sf_dir), 1000)


@query("queue_depth_recent")
def q_qd_recent(spark, sf_dir):
    return metrics.queue_depth_recent(worker_metrics(spark, sf_dir), 100, 1000)


@query("stream_throughput")
def q_stream_tp(spark, sf_dir):
    return metrics.stream_throughput(batch_table(spark, sf_dir), 6, 10.0)


@query("batch_duration")
def q_batch_duration(spark, sf_dir):
    return metrics.batch_duration(batch_table(spark, sf_dir))


@query("batch_metrics")
def q_batch_metrics(spark, sf_dir):
    t = ticks(spark, sf_dir).withColumn("batch_id", F.floor(F.col("seq") / 100).cast("long"))
    return metrics.batch_metrics(t).withColumn("per_symbol", F.to_json("per_symbol"))


# ---- sources, sinks and projections (S*, K*, P1-P5, U1) ---------------------


RAW_COLS = RAW_TICK.fieldNames()


def scratch(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tickwise-io/{name}-{uuid.uuid4().hex[:12]}"


@query("json_encode")
def q_json_encode(spark, sf_dir):
    return tick_io.encode_ticks(ticks(spark, sf_dir), keep=("seq",))


@query("json_decode")
def q_json_decode(spark, sf_dir):
    t = ticks(spark, sf_dir)
    msgs = tick_io.encode_ticks(t, keep=("seq",)).drop("key")
    d = tick_io.decode_ticks(msgs)
    return d.select("seq", "symbol", "sector", "open", "high", "low", "close", "volume", "timestamp",
                    "kafka_produce_time", "data_type", "event_time", "date", "quarantine")


@query("event_time_parse")
def q_event_time_parse(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return (t.select("symbol", "seq", "timestamp",
                     parse_event_time(F.col("timestamp")).alias("event_time_parsed"))
             .where(F.col("event_time_parsed").isNotNull()))


@query("event_date")
def q_event_date(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.select(*KEY, F.coalesce(F.col("date"), F.to_date("event_time")).alias("date"))


@query("legacy_alias")
def q_legacy_alias(spark, sf_dir):
    t = ticks(spark, sf_dir).select("symbol", "seq", "timestamp", "close")
    return tables.legacy_alias(t)


@query("sector_lookup")
def q_sector_lookup(spark, sf_dir):
    dim = adapters.customer_region_dim(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
                                       table(spark, sf_dir, "region"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return (lookup_join(orders, dim, orders.o_custkey == dim.key)
            .select("o_orderkey", "o_custkey", F.coalesce("sector", F.lit("Unknown")).alias("sector"),
                    "o_totalprice"))


@query("union_history")
def q_union_history(spark, sf_dir):
    e = enriched(spark, sf_dir)
    history = e.where(F.col("date") < F.lit("2024-01-15")).select(*KEY, "close", "moving_avg_5")
    new = e.where(F.col("date") >= F.lit("2024-01-15")).select(*KEY, "close", "volume")
    return history.unionByName(new, allowMissingColumns=True)


@query("sink_raw_roundtrip")
def q_sink_raw(spark, sf_dir):
    path = scratch(spark, "raw")
    sinks.write_raw(ticks(spark, sf_dir), path, mode="overwrite")
    return tables.read_raw(spark, path).select(*RAW_COLS)


@query("sink_enriched_roundtrip")
def q_sink_enriched(spark, sf_dir):
    path = scratch(spark, "enriched")
    sinks.write_enriched(enriched(spark, sf_dir), path, mode="overwrite")
    return spark.read.schema(ENRICHED_TICK).parquet(path).select(*ENRICHED_COLS)


@query("scan_enriched")
def q_scan_enriched(spark, sf_dir):
    path = scratch(spark, "enriched")
    sinks.write_enriched(enriched(spark, sf_dir), path, mode="overwrite")
    df = tables.read_enriched(spark, path)
    return (df.where(F.col("symbol").isin("U1", "U2", "U3", "U50") & (F.col("date") >= F.lit("2024-01-10")))
              .select(*KEY, "sector", "close", "rsi_14", "date"))


@query("scan_recent")
def q_scan_recent(spark, sf_dir):
    path = scratch(spark, "enriched")
    sinks.write_enriched(enriched(spark, sf_dir), path, mode="overwrite")
    return tables.read_enriched(spark, path, minutes=24 * 60).select(*KEY, "sector", "close", "vwap")


@query("scan_raw")
def q_scan_raw(spark, sf_dir):
    path = scratch(spark, "raw")
    sinks.write_raw(ticks(spark, sf_dir), path, batch_id=0)
    sinks.write_raw(ticks(spark, sf_dir), path, batch_id=0)   # re-run of the same batch: no duplicates
    return (tables.read_raw(spark, path).groupBy("date")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume")))


@query("scan_worker_metrics")
def q_scan_workers(spark, sf_dir):
    path = scratch(spark, "workers")
    w = worker_metrics(spark, sf_dir)
    sinks.write_jsonl(w.select(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                               "worker_id", F.lit(None).cast("int").alias("symbols_count"),
                               "messages_sent", "queue_depth"), path, mode="overwrite")
    return tables.read_worker_metrics(spark, path).select("timestamp", "worker_id", "messages_sent",
                                                          "queue_depth")


@query("scan_batch_metrics")
def q_scan_batches(spark, sf_dir):
    path = scratch(spark, "batches")
    t = ticks(spark, sf_dir).withColumn("batch_id", F.floor(F.col("seq") / 100).cast("long"))
    b = metrics.batch_metrics(t).withColumn("timestamp", F.lit("2024-01-01T00:00:00")) \
        .withColumn("elapsed_ms", F.lit(0.0))
    sinks.write_jsonl(b, path, mode="overwrite")
    return tables.explode_per_symbol(tables.read_batch_metrics(spark, path))


@query("state_bootstrap")
def q_state_bootstrap(spark, sf_dir):
    path = scratch(spark, "state")
    sinks.write_state_snapshot(enriched(spark, sf_dir), path, 50)
    return tables.load_state_snapshot(spark, path).select(*ENRICHED_COLS)


@query("storage_footprint")
def q_footprint(spark, sf_dir):
    root = scratch(spark, "tables")
    sinks.write_enriched(enriched(spark, sf_dir), f"{root}/processed", mode="overwrite")
    sinks.write_raw(ticks(spark, sf_dir), f"{root}/raw_ticks", mode="overwrite")
    return quality.storage_footprint(spark, [f"{root}/processed", f"{root}/raw_ticks"])


# ---- streaming (R1-R10, S1) ---------------------------------------------------


STREAM_COLS = ["symbol", "sector", "open", "high", "low", "close", "volume", "event_time",
               "kafka_produce_time", "data_type", "timestamp", "seq", "spark_process_time", "date"]
END_OF_INPUT = _dt.datetime(2200, 1, 1)


FILES = 4      # files of a slice, read together by one micro-batch


def in_slices(t: DataFrame, n_slices: int) -> DataFrame:
    """Ticks with the event-time slice they belong to, by day; the last day has rank 1."""
    days = t.select("date").distinct()
    place = days.withColumn("slice", F.least(
        F.floor(F.percent_rank().over(Window.orderBy("date")) * F.lit(n_slices)), F.lit(n_slices - 1)))
    return t.join(F.broadcast(place), "date")       # one row per day


def stage_tick_files(spark, sf_dir, root: str, n_slices: int = 3, first: int = 0,
                     last: int | None = None, marker: bool = True, ticks_of=None) -> None:
    """Write the T1 ticks as event-time slices of ``FILES`` files each (one write
    job per slice, so file order is arrival order) plus an end-of-input marker
    row whose event time moves the watermark past every buffered row."""
    t = in_slices((ticks_of or ticks)(spark, sf_dir).select(*STREAM_COLS), n_slices)
    last = n_slices if last is None else last
    for k in range(first, last):
        # rows inside a slice arrive in arbitrary order
        (t.where(F.col("slice") == k).select(*STREAM_COLS).repartition(FILES).sortWithinPartitions(F.xxhash64("seq"))
          .write.mode("append").parquet(f"{root}/in"))
    if marker:
        end_of_input(spark, f"{root}/in", t.select(*STREAM_COLS).schema)


def end_of_input(spark, path: str, schema) -> None:
    """Append the marker row that ends a finite input."""
    end = spark.createDataFrame([(None, END_OF_INPUT, -1)], "symbol string, event_time timestamp_ntz, seq long")
    conform(end, schema).coalesce(1).write.mode("append").parquet(path)


def run_enrichment(spark, root: str, schema, partitions=("date",), late_horizon=LATE_HORIZON, files=FILES):
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
    paths = stream_job.SinkPaths(enriched=f"{root}/enriched", late=f"{root}/late",
                                 metrics=f"{root}/metrics", checkpoint=f"{root}/ckpt")
    q = stream_job.start_enrichment(src, paths, trigger={"availableNow": True},
                                    enriched_partitions=partitions, late_horizon=late_horizon)
    q.awaitTermination()
    return paths


def _tick_schema(spark, sf_dir):
    return ticks(spark, sf_dir).select(*STREAM_COLS).schema


@query("stream_enrich")
def q_stream_enrich(spark, sf_dir):
    root = scratch(spark, "stream")
    stage_tick_files(spark, sf_dir, root)
    paths = run_enrichment(spark, root, _tick_schema(spark, sf_dir))
    return spark.read.schema(ENRICHED_TICK).parquet(paths.enriched).select(*ENRICHED_COLS)


@query("stream_restart")
def q_stream_restart(spark, sf_dir):
    root = scratch(spark, "restart")
    schema = _tick_schema(spark, sf_dir)
    stage_tick_files(spark, sf_dir, root, first=0, last=2, marker=False)
    run_enrichment(spark, root, schema)              # stops after the first files
    stage_tick_files(spark, sf_dir, root, first=2)   # more input arrives
    paths = run_enrichment(spark, root, schema)      # restart on the same checkpoint
    return spark.read.schema(ENRICHED_TICK).parquet(paths.enriched).select(*ENRICHED_COLS)


@query("stream_batch_metrics")
def q_stream_metrics(spark, sf_dir):
    root = scratch(spark, "stream-metrics")
    stage_tick_files(spark, sf_dir, root)
    paths = run_enrichment(spark, root, _tick_schema(spark, sf_dir))
    m = tables.read_batch_metrics(spark, paths.metrics)
    return tables.explode_per_symbol(m).groupBy("symbol").agg(F.sum("rows").alias("rows"))


@query("stream_compaction")
def q_stream_compaction(spark, sf_dir):
    # per-batch output of the stream (one folder per batch id) -> one file
    # set per date
    root = scratch(spark, "compact")
    stage_tick_files(spark, sf_dir, root)
    paths = run_enrichment(spark, root, _tick_schema(spark, sf_dir))
    sinks.compact(spark, paths.enriched, f"{root}/compacted", partition_cols=("date",))
    return spark.read.schema(ENRICHED_TICK).parquet(f"{root}/compacted").select(*ENRICHED_COLS)


@query("stream_minute_counts")
def q_stream_minutes(spark, sf_dir):
    root = scratch(spark, "minutes")
    stage_tick_files(spark, sf_dir, root)
    src = spark.readStream.schema(_tick_schema(spark, sf_dir)).option("maxFilesPerTrigger", FILES) \
        .parquet(f"{root}/in")
    q = (minute_counts(src).writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("stream_source_file")
def q_stream_source(spark, sf_dir):
    root = scratch(spark, "json-source")
    msgs = tick_io.encode_ticks(ticks(spark, sf_dir), keep=("seq",))
    # one JSON object per line, the topic's message values
    msgs.select(F.to_json(F.struct(F.col("seq"), F.col("value"))).alias("value")) \
        .write.mode("overwrite").text(f"{root}/in")
    src = tick_io.tick_source(spark, tick_io.SourceConf(format="json", path=f"{root}/in", max_per_trigger=2))
    env = src.select(F.from_json("value", "seq long, value string").alias("m")).select("m.seq", "m.value")
    decoded = tick_io.good_ticks(tick_io.decode_ticks(env))
    q = (decoded.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "seq", "symbol", "sector", "open", "high", "low", "close", "volume", "timestamp",
        "kafka_produce_time", "data_type", "event_time", "date")


LATE_SEQ_OFFSET = 10 ** 12


@query("stream_late_rows")
def q_stream_late(spark, sf_dir):
    root = scratch(spark, "late")
    schema = _tick_schema(spark, sf_dir)
    stage_tick_files(spark, sf_dir, root, marker=False)
    # re-sent copies of the first day's ticks arrive after everything else
    t = ticks(spark, sf_dir).select(*STREAM_COLS)
    first_day = t.agg(F.min("date").alias("d"))
    (t.join(F.broadcast(first_day), t["date"] == F.col("d"), "left_semi")
      .withColumn("seq", F.col("seq") + F.lit(LATE_SEQ_OFFSET))
      .repartition(FILES).write.mode("append").parquet(f"{root}/in"))
    end_of_input(spark, f"{root}/in", schema)
    paths = run_enrichment(spark, root, schema)
    late = spark.read.schema(ENRICHED_TICK).json(paths.late)
    return late.select("symbol", "event_time", "seq", "close")


def gap_ticks(spark, sf_dir):
    """Ticks with missing volumes and opens."""
    t = ticks(spark, sf_dir)
    return (t.withColumn("volume", F.when(F.col("seq") % 7 != 0, F.col("volume")))
             .withColumn("open", F.when(F.col("seq") % 11 != 0, F.col("open"))))


@query("enrich_gaps")
def q_enrich_gaps(spark, sf_dir):
    return enrich(gap_ticks(spark, sf_dir)).select(*ENRICHED_COLS)


@query("stream_gaps")
def q_stream_gaps(spark, sf_dir):
    root = scratch(spark, "gaps")
    stage_tick_files(spark, sf_dir, root, ticks_of=gap_ticks)
    paths = run_enrichment(spark, root, _tick_schema(spark, sf_dir))
    return spark.read.schema(ENRICHED_TICK).parquet(paths.enriched).select(*ENRICHED_COLS)


def messages(spark, sf_dir):
    """Tick messages of which some are broken, dated far ahead or without a symbol."""
    m = tick_io.encode_ticks(ticks(spark, sf_dir), keep=("seq",))
    ahead = F.regexp_replace("value", '"timestamp":"20', '"timestamp":"30')
    nobody = F.regexp_replace("value", '"symbol":"[^"]*"', '"symbol":null')
    return m.select("seq", F.when(F.col("seq") % 13 == 0, F.concat(F.lit("{"), "value"))
                    .when(F.col("seq") % 17 == 0, ahead).when(F.col("seq") % 19 == 0, nobody)
                    .otherwise(F.col("value")).alias("value"))


def _ingest(spark, sf_dir):
    """Messages through the whole job: raw archive, quarantine, enrichment."""
    root = scratch(spark, "ingest")
    messages(spark, sf_dir).write.parquet(f"{root}/in")
    src = spark.readStream.schema("seq long, value string").parquet(f"{root}/in")
    paths = stream_job.SinkPaths(enriched=f"{root}/enriched", late=f"{root}/late", metrics=f"{root}/metrics",
                                 raw=f"{root}/raw", quarantine=f"{root}/quarantine", checkpoint=f"{root}/ckpt")
    decoded = tick_io.decode_ticks(src)
    for q in (stream_job.start_raw_archive(decoded, paths, {"availableNow": True}),
              stream_job.start_quarantine(decoded, paths, {"availableNow": True})):
        q.awaitTermination()
    return paths


@query("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    q = spark.read.schema("quarantine string, _raw string").json(_ingest(spark, sf_dir).quarantine)
    return q.groupBy("quarantine").agg(F.count(F.lit(1)).alias("rows"))


@query("stream_raw_archive")
def q_stream_raw(spark, sf_dir):
    raw = spark.read.schema(RAW_TICK).parquet(_ingest(spark, sf_dir).raw)
    return raw.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))


@query("enrich_hot")
def q_enrich_hot(spark, sf_dir):
    # thresholds below the longest series, and ticks without a symbol: some
    # symbols take the split plan, the others the plain one
    t = ticks_from_events(table(spark, sf_dir, "events"), with_prices=False)
    nobody = t.where(F.col("seq") % 50 == 0).withColumn("symbol", F.lit(None).cast("string"))
    both = t.unionByName(nobody)
    return enrich(both, split_rows=66, split_block_rows=40, rsi_block=20, open_from_close=True).select(*ENRICHED_COLS)


@query("enrich_split")
def q_enrich_split(spark, sf_dir):
    # blocks of 40 rows (rebased every 20) so that every symbol's series of
    # 50-90 ticks is cut into several blocks here
    from tickwise.operators.split_enrich import split_enrich
    t = ticks_from_events(table(spark, sf_dir, "events"), with_prices=False)
    return split_enrich(t, block_rows=40, rsi_block=20, open_from_close=True).select(*ENRICHED_COLS)


@query("dedup_ticks")
def q_dedup(spark, sf_dir):
    # brand bars by ship date: the same part shipped twice a day in the same
    # quantity is a re-sent bar
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    price = F.try_divide("l_extendedprice", "l_quantity")
    t = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_brand").alias("symbol"), F.col("l_shipdate").alias("event_time"),
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
        F.col("l_quantity").cast("long").alias("volume"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_suppkey").alias("supplier"))
    return snapshot.dedup_ticks(t)


# ---- the stream with its state in tables (R2, R5, R8, S7, K4, K5) -------------


def run_carried(spark, root: str, schema, **options) -> carried.CarriedEnrichment:
    """All staged files through the stream; the rows that still wait are flushed."""
    e = carried.CarriedEnrichment(spark, f"{root}/store", **options)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(f"{root}/in")
    carried.start(src, e, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return e


def _carried(spark, sf_dir, name: str, **options):
    root = scratch(spark, name)
    stage_tick_files(spark, sf_dir, root, marker=False)
    e = run_carried(spark, root, _tick_schema(spark, sf_dir), **options)
    e.flush()
    return e


@query("stream_carried")
def q_stream_carried(spark, sf_dir):
    return carried.read_enriched(_carried(spark, sf_dir, "carried").store).select(*ENRICHED_COLS)


@query("stream_warm_start")
def q_stream_warm_start(spark, sf_dir):
    # the end of the first two thirds is the state that the stream of the last third begins with
    root = scratch(spark, "warm")
    t = in_slices(ticks(spark, sf_dir).select(*STREAM_COLS), 3)
    e = carried.CarriedEnrichment(spark, f"{root}/store")
    e.warm_start(carried.state_of(t.where("slice < 2").select(*STREAM_COLS)))
    stage_tick_files(spark, sf_dir, root, first=2, marker=False)
    e = run_carried(spark, root, _tick_schema(spark, sf_dir))
    e.flush()
    return carried.read_enriched(e.store).select(*ENRICHED_COLS)


def stage_late_files(spark, sf_dir, root: str, times: int) -> None:
    """One tick of twelve arrives after all others, ``times`` times."""
    held = F.col("seq") % 50 < 4
    stage_tick_files(spark, sf_dir, root, n_slices=2, marker=False,
                     ticks_of=lambda s, d: ticks(s, d).where(~held))
    for _ in range(times):
        (ticks(spark, sf_dir).where(held).select(*STREAM_COLS).repartition(FILES)
         .write.mode("append").parquet(f"{root}/in"))


@query("stream_late_merged")
def q_stream_late_merged(spark, sf_dir):
    root = scratch(spark, "late-merged")
    stage_late_files(spark, sf_dir, root, 2)       # the second time they are repeats
    e = run_carried(spark, root, _tick_schema(spark, sf_dir))
    e.flush()
    return carried.read_enriched(e.store).select(*ENRICHED_COLS)


@query("stream_growth")
def q_stream_growth(spark, sf_dir):
    root = scratch(spark, "growth")
    stage_late_files(spark, sf_dir, root, 1)
    g = growth.CarriedGrowth(spark, f"{root}/store")
    src = spark.readStream.schema(_tick_schema(spark, sf_dir)).option("maxFilesPerTrigger", FILES).parquet(f"{root}/in")
    growth.start(src, g, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    g.flush()
    return g.read()


def hot_ticks(spark, sf_dir):
    """Ticks of which every second one is of one symbol."""
    t = ticks_from_events(table(spark, sf_dir, "events"), with_prices=False)
    t = t.withColumn("symbol", F.when(F.col("seq") % 2 == 0, F.lit("HOT")).otherwise(F.col("symbol")))
    return with_open(t, symbol_window())


@query("stream_hot")
def q_stream_hot(spark, sf_dir):
    # blocks of 500 rows, so that the hot symbol's rows of a batch are many blocks
    root = scratch(spark, "hot")
    stage_tick_files(spark, sf_dir, root, marker=False, ticks_of=hot_ticks)
    e = run_carried(spark, root, _tick_schema(spark, sf_dir), block_rows=500, rsi_block=100)
    e.flush()
    return carried.read_enriched(e.store).select(*ENRICHED_COLS)


@query("stream_batch_rows")
def q_stream_batch_rows(spark, sf_dir):
    rows = carried.batch_rows(_carried(spark, sf_dir, "batch-rows").store)
    return rows.groupBy("symbol").agg(F.sum("n").alias("rows"))


@query("state_export")
def q_state_export(spark, sf_dir):
    # the history snapshot read from the stream's own state, after a restart
    root = scratch(spark, "state-export")
    schema = _tick_schema(spark, sf_dir)
    stage_tick_files(spark, sf_dir, root, first=0, last=2, marker=False)
    run_carried(spark, root, schema)
    stage_tick_files(spark, sf_dir, root, first=2, marker=False)
    e = run_carried(spark, root, schema)
    e.flush()
    return e.state().select(*ENRICHED_COLS)


class Killed(Exception):
    """The job ends between two tables of a batch."""


def _atomic_ingest(spark, sf_dir):
    """Messages through the whole job, which dies once between two tables of its second batch."""
    root = scratch(spark, "atomic")
    m = messages(spark, sf_dir).join(in_slices(ticks(spark, sf_dir), 3).select("seq", "slice"), "seq")
    for k in range(3):
        m.where(F.col("slice") == k).select("seq", "value").repartition(FILES).write.mode("append").parquet(f"{root}/in")
    e = carried.CarriedEnrichment(spark, f"{root}/store")

    def die(batch_id):
        if batch_id == 1:
            raise Killed

    for after_raw in (die, None):
        src = spark.readStream.schema("seq long, value string").option("maxFilesPerTrigger", FILES).parquet(f"{root}/in")
        q = stream_job.start_atomic_ingest(tick_io.decode_ticks(src), e, f"{root}/ckpt", {"availableNow": True}, after_raw)
        try:
            q.awaitTermination()
        except StreamingQueryException as x:
            if "Killed" not in str(x):
                raise
    e.flush()
    return e


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    return carried.read_enriched(_atomic_ingest(spark, sf_dir).store).select(
        *KEY, "close", "volume", "moving_avg_5", "moving_avg_20", "volatility", "rsi_14", "vwap", "volume_trend",
        "price_change_pct", "crash_score")


@query("stream_ingest_tables")
def q_stream_ingest_tables(spark, sf_dir):
    store = _atomic_ingest(spark, sf_dir).store
    raw = store.read("raw", "symbol string, close double, date date")
    aside = store.read("quarantine", "quarantine string")
    parts = {"raw": raw, "quarantine": aside, "enriched": carried.read_enriched(store),
             "metrics": carried.batch_rows(store).select(F.explode(F.sequence(F.lit(1).cast("long"), "n")))}
    out = None
    for name, df in parts.items():
        n = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = n if out is None else out.unionByName(n)
    return out


# ---- indicators over a trailing frame or a day (W5, W6) ------------------------


@query("vwap_daily")
def q_vwap_daily(spark, sf_dir):
    return trailing.with_vwap(ticks(spark, sf_dir), reset="date").select(*KEY, "vwap")


@query("vwap_lookback")
def q_vwap_lookback(spark, sf_dir):
    return trailing.with_vwap(ticks(spark, sf_dir), lookback=20).select(*KEY, "vwap")


@query("rsi_lookback")
def q_rsi_lookback(spark, sf_dir):
    return trailing.with_rsi(ticks(spark, sf_dir), lookback=30).select(*KEY, "rsi_14")
