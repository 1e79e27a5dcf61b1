"""Event-time tumbling windows on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickwise.functions.timefns import ntz_from_instant, utc_instant


def minute_counts(ticks: DataFrame, watermark: str = "5 minutes", width: str = "1 minute") -> DataFrame:
    """Rows per event-time minute; a window is emitted once the watermark
    passes its end (append mode), late rows beyond the watermark are
    not counted."""
    s = ticks.withColumn("_wm", utc_instant("event_time")).withWatermark("_wm", watermark)
    # keyless rows (end-of-input markers) still move the watermark; they are
    # not counted, and windows holding only such rows are dropped after the
    # aggregate (a filter before it would be pushed below the watermark)
    return (s.groupBy(F.window("_wm", width).alias("w"))
             .agg(F.count("symbol").alias("count"))
             .where(F.col("count") > 0)
             .select(ntz_from_instant(F.col("w.start")).alias("minute"), "count"))
