"""Producer (worker) and streaming (batch) metrics views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def worker_throughput(metrics: DataFrame, n: int = 40, order=("timestamp", "seq")) -> DataFrame:
    """Messages per worker over the newest ``n`` metric rows."""
    recent = metrics.orderBy(*[F.col(c).desc() for c in order if c in metrics.columns]).limit(n)
    return recent.groupBy("worker_id").agg(F.sum("messages_sent").alias("messages_sent"))


def queue_depth_alerts(metrics: DataFrame, threshold: int = 1000) -> DataFrame:
    """Metric rows whose queue depth is above ``threshold``."""
    return metrics.where(F.col("queue_depth") > threshold).select("timestamp", "worker_id", "queue_depth")


def queue_depth_recent(metrics: DataFrame, n: int = 100, threshold: int = 1000,
                       order=("timestamp", "seq")) -> DataFrame:
    """Newest ``n`` queue-depth points, oldest first, with the threshold breach flag."""
    by = [F.col(c) for c in order if c in metrics.columns]
    recent = metrics.orderBy(*[c.desc() for c in by]).limit(n).orderBy(*by)
    return recent.select("timestamp", "worker_id", "queue_depth",
                         (F.col("queue_depth") > threshold).alias("above_threshold"))


def stream_throughput(batches: DataFrame, n: int = 6, trigger_s: float = 10.0) -> DataFrame:
    """Mean rows of the last ``n`` batches and rows/s at the trigger interval."""
    recent = batches.orderBy(F.col("batch_id").desc()).limit(n)
    return recent.agg(F.avg("total_rows").alias("avg_rows_per_batch"),
                      (F.avg("total_rows") / F.lit(trigger_s)).alias("rows_per_sec"))


def batch_duration(batches: DataFrame) -> DataFrame:
    return batches.agg(F.avg("elapsed_ms").alias("avg_batch_ms"), F.count(F.lit(1)).alias("batches"))


def rows_per_symbol(df: DataFrame, key: str = "symbol") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def batch_metrics(df: DataFrame, batch_col: str = "batch_id", key: str = "symbol") -> DataFrame:
    """Per batch: total rows and a symbol -> rows map (A2/K4).

    Counts are pre-aggregated per (batch, symbol); the map then collects
    at most one entry per symbol of the batch.
    """
    per = df.groupBy(batch_col, key).agg(F.count(F.lit(1)).alias("n"))
    return (per.groupBy(batch_col)
               .agg(F.sum("n").alias("total_rows"),
                    F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("per_symbol")))
