"""Batch durations and sizes from Spark's own streaming progress events.

``ProgressRecorder`` is a StreamingQueryListener: for each micro-batch it
keeps one small record (batch id, input rows, trigger duration, watermark)
of the progress event Spark already sends to the driver.  ``frame()``
returns them as a DataFrame with the batch-metrics columns, so the
throughput / duration views (``stream_throughput``, ``batch_duration``)
run on live query progress as well as on the JSON metrics log.

Every record is kept (about 200 bytes a micro-batch); ``keep`` bounds them
for a listener that should only know the newest.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = ("query_name string, batch_id long, timestamp string, total_rows long, "
                   "elapsed_ms double, watermark string")


class ProgressRecorder(StreamingQueryListener):
    def __init__(self, keep: int | None = None):
        self._rows: list[tuple] = []
        self._keep = keep
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        dur = (p.durationMs or {}).get("triggerExecution")
        wm = (p.eventTime or {}).get("watermark")
        with self._lock:
            self._rows.append((p.name, int(p.batchId), p.timestamp, int(p.numInputRows),
                               float(dur) if dur is not None else None, wm))
            if self._keep is not None:
                del self._rows[:-self._keep]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = list(self._rows)
        return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def attach(spark: SparkSession, keep: int | None = None) -> ProgressRecorder:
    rec = ProgressRecorder(keep)
    spark.streams.addListener(rec)
    return rec
