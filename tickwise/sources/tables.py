"""Readers for the stored tables and logs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwise.functions.timefns import parse_event_time
from tickwise.operators.snapshot import recent_window, sector_default
from tickwise.schema import BATCH_METRIC, ENRICHED_TICK, RAW_TICK, WORKER_METRIC


def legacy_alias(df: DataFrame) -> DataFrame:
    """Older tables only carry the ``timestamp`` string: derive ``event_time``."""
    if "event_time" not in df.columns and "timestamp" in df.columns:
        return df.withColumn("event_time", parse_event_time(F.col("timestamp")))
    return df


def read_enriched(spark: SparkSession, path: str, minutes: int = 0,
                  schema=ENRICHED_TICK, literal_cutoff: bool = True) -> DataFrame:
    """The enriched table as the views expect it.

    Partition columns (symbol, date) come from the folder layout, so
    filters on them prune folders.  Rows without event time are dropped,
    sector defaults to ``Unknown`` and ``minutes`` keeps the latest span.

    With ``literal_cutoff`` the latest event time is read first (one job
    over the event_time column) and the span becomes literal predicates
    ``date >= d`` and ``event_time >= t``: the first prunes date folders,
    the second is pushed into the Parquet scan.  Otherwise the cutoff is a
    broadcast one-row aggregate compared per row.
    """
    df = legacy_alias(spark.read.schema(schema).parquet(path))
    df = sector_default(df.where(F.col("event_time").isNotNull()))
    if minutes > 0 and literal_cutoff:
        newest = df
        if "date" in df.columns:   # the newest date comes from the folders, its latest time from its files
            day = df.agg(F.max("date")).first()[0]
            newest = df.where(F.col("date") == F.lit(day)) if day is not None else df
        mx = newest.agg(F.max("event_time")).first()[0]
        if mx is None:
            return df
        cut = mx - _dt.timedelta(minutes=minutes)
        out = df.where(F.col("event_time") >= F.lit(cut))
        if "date" in df.columns:
            out = out.where(F.col("date") >= F.lit(cut.date()))
        return out
    return recent_window(df, minutes)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_TICK).parquet(path)


def read_worker_metrics(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; blank lines are skipped, bad timestamps become null."""
    df = spark.read.schema(WORKER_METRIC).json(path)
    return df.withColumn("timestamp", F.try_to_timestamp(F.col("timestamp")).cast("timestamp_ntz"))


def read_batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(BATCH_METRIC).json(path)
    return df.withColumn("timestamp", F.try_to_timestamp(F.col("timestamp")).cast("timestamp_ntz"))


def explode_per_symbol(batches: DataFrame) -> DataFrame:
    return batches.select("batch_id", F.explode("per_symbol").alias("symbol", "rows"))


def load_state_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """History snapshot (JSON lines of enriched rows) for a warm start."""
    return spark.read.schema(ENRICHED_TICK).json(path)
