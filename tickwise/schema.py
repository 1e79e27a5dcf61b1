"""Declared schemas: one StructType per table, cast before every write."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, LongType,
                               MapType, StringType, StructField, StructType,
                               TimestampNTZType, IntegerType)

# Tick message as published on the topic (all fields nullable).
TICK_MESSAGE = StructType([
    StructField("symbol", StringType()),
    StructField("sector", StringType()),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("close", DoubleType()),
    StructField("volume", LongType()),
    StructField("timestamp", StringType()),
    StructField("kafka_produce_time", LongType()),
    StructField("data_type", StringType()),
])

# Raw archive (partitioned by date).
RAW_TICK = StructType([
    StructField("symbol", StringType()),
    StructField("sector", StringType()),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("close", DoubleType()),
    StructField("volume", LongType()),
    StructField("event_time", TimestampNTZType()),
    StructField("kafka_produce_time", LongType()),
    StructField("data_type", StringType()),
    StructField("date", DateType()),
])

INDICATOR_FIELDS = [
    StructField("moving_avg_5", DoubleType()),
    StructField("moving_avg_20", DoubleType()),
    StructField("volatility", DoubleType()),
    StructField("rsi_14", DoubleType()),
    StructField("vwap", DoubleType()),
    StructField("volume_trend", DoubleType()),
    StructField("price_change_pct", DoubleType()),
    StructField("crash_score", BooleanType()),
    StructField("spark_process_time", LongType()),
    StructField("latency_ms", LongType()),
]

# Enriched tick table (partitioned by symbol, date).  ``seq`` is the
# tie-breaker for equal event times (topic partition/offset or input id).
ENRICHED_TICK = StructType(
    RAW_TICK.fields[:10]
    + [StructField("timestamp", StringType()), StructField("seq", LongType())]
    + INDICATOR_FIELDS
    + [RAW_TICK.fields[10]]
)

# Producer worker metrics (JSON lines).
WORKER_METRIC = StructType([
    StructField("timestamp", StringType()),
    StructField("worker_id", IntegerType()),
    StructField("symbols_count", IntegerType()),
    StructField("messages_sent", LongType()),
    StructField("queue_depth", LongType()),
])

# Streaming batch metrics (JSON lines with a map column).
BATCH_METRIC = StructType([
    StructField("timestamp", StringType()),
    StructField("batch_id", LongType()),
    StructField("total_rows", LongType()),
    StructField("per_symbol", MapType(StringType(), LongType())),
    StructField("elapsed_ms", DoubleType()),
])

# The analytics columns a complete enriched table must carry.
EXPECTED_ANALYTICS_COLS = [
    "symbol", "sector", "open", "high", "low", "close", "volume",
    "event_time", "data_type", "kafka_produce_time",
    "moving_avg_5", "moving_avg_20", "price_change_pct", "volatility",
    "vwap", "rsi_14", "volume_trend", "crash_score",
    "spark_process_time", "latency_ms",
]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema``; missing columns become typed nulls."""
    cols = []
    have = set(df.columns)
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
