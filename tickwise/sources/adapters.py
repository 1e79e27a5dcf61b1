"""Shape the driver's generic tables as ticks and metrics.

These adapters are the only place that knows about the driver tables;
everything downstream sees the tick, worker-metric and batch-metric
schemas.  All adapters are plain projections (plus one lag over the
symbol series), so Catalyst prunes the scans to the columns used.

T1 ticks     <- events            (symbol per user, close = value)
T2 ticks     <- lineitem x part   (symbol = brand, for pivot/correlation)
T3 workers   <- events            (worker metrics)
T4 batches   <- events            (batch metrics)
T5 dimension <- customer x nation x region
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickwise.functions.timefns import epoch_ms
from tickwise.operators.enrich import with_open


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks_from_events(events: DataFrame, with_prices: bool = True) -> DataFrame:
    """T1: one tick per event; ``seq`` = event_id breaks event-time ties.

    Open, high and low need the close before; without ``with_prices`` they are
    left to ``enrich(open_from_close=True)``, which derives them inside its own
    windows, so a hot symbol isn't gathered here."""
    k = F.from_json(F.col("props"), "k BIGINT").getField("k")
    base = events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.when(F.col("user_id") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("S"), (F.col("user_id") % 6).cast("string"))).alias("sector"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("close"),
        k.alias("volume"),
        F.when(F.col("event_type") == "error", F.lit("simulated")).otherwise(F.lit("real")).alias("data_type"),
    )
    ms = epoch_ms(F.col("event_time"))
    if with_prices:
        base = with_open(base, Window.partitionBy("symbol").orderBy("event_time", "seq"))
    return (base
            .withColumn("kafka_produce_time",
                        F.when(F.col("volume") % 10 == 0, F.lit(None).cast("long")).otherwise(ms))
            .withColumn("spark_process_time", ms + F.lit(5) + F.lit(3) * F.col("volume"))
            .withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
            .withColumn("date", F.to_date("event_time")))


def ticks_from_lineitem(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """T2: brand-level prices by ship date (ties are common; averaged later)."""
    li = lineitem.select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    p = part.select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("p_brand").alias("symbol"),
                    F.col("l_shipdate").alias("event_time"),
                    F.try_divide("l_extendedprice", "l_quantity").alias("close"),
                    F.col("l_quantity").cast("long").alias("volume")))


def worker_metrics_from_events(events: DataFrame) -> DataFrame:
    """T3: producer worker metrics."""
    k = F.from_json(F.col("props"), "k BIGINT").getField("k")
    return events.select(
        F.col("ts").alias("timestamp"),
        (F.col("user_id") % 4).cast("int").alias("worker_id"),
        k.alias("messages_sent"),
        (F.col("value") * 10).cast("long").alias("queue_depth"),
        F.col("event_id").alias("seq"),
    )


def batch_metrics_from_events(events: DataFrame) -> DataFrame:
    """T4: one metrics row per 100 events (batch_id = event_id div 100)."""
    return (events
            .groupBy(F.floor(F.col("event_id") / 100).cast("long").alias("batch_id"))
            .agg(F.count(F.lit(1)).alias("total_rows"),
                 F.sum("value").alias("elapsed_ms"),
                 F.max("ts").alias("timestamp")))


def customer_region_dim(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """T5: key -> region name, a symbol->sector style dimension."""
    return (customer.select("c_custkey", "c_nationkey")
            .join(nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("key"), F.col("r_name").alias("sector")))
