"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully materialised with a ``noop`` write (no collect to
the driver), once to warm the JVM and once timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickwise.plans.catalog import QUERIES  # noqa: E402
from tickwise.session import get_spark  # noqa: E402

HEADLINE = [
    "enrich_ticks", "latest_per_symbol", "sector_performance", "top_gainers", "market_kpis",
    "crash_summary", "tail_per_symbol", "vwap_deviation", "corr_matrix", "growth_per_minute",
    "latency_stats", "latency_histogram", "rows_per_symbol", "schema_profile", "batch_metrics",
]


def timed_stream(spark, sf_dir) -> tuple[float, float]:
    """Seconds to stage the input files, and to run the stream over them."""
    from tickwise.plans import catalog
    root = catalog.scratch(spark, "bench-stream")
    t0 = time.perf_counter()
    catalog.stage_tick_files(spark, sf_dir, root)
    t1 = time.perf_counter()
    catalog.run_enrichment(spark, root, catalog._tick_schema(spark, sf_dir))
    return t1 - t0, time.perf_counter() - t1


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="tickwise-bench", shuffle_partitions=int(cpus) * 2)
    timings = {}
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    extra = {}
    if names == HEADLINE:
        t0 = time.perf_counter()
        QUERIES["sink_enriched_roundtrip"](spark, sf_dir).write.format("noop").mode("overwrite").save()
        extra["sink_enriched_roundtrip"] = round(time.perf_counter() - t0, 3)
        staged, streamed = timed_stream(spark, sf_dir)
        extra["stream_staging"], extra["stream_enrich"] = round(staged, 3), round(streamed, 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(timings.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "writes": extra,
        "sink_rows_per_sec": round(rows / extra["sink_enriched_roundtrip"], 1) if extra else None,
        "stream_rows_per_sec": round(rows / extra["stream_enrich"], 1) if extra else None,
        "enrich_rows_per_sec": round(rows / timings["enrich_ticks"], 1) if "enrich_ticks" in timings else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
