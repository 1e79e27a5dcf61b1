"""The streaming ingest job: source -> decode -> stateful enrich -> sinks.

Two queries share the source, each with its own checkpoint:
* the raw archive (every decoded row, partitioned by date), and
* the enrichment, whose thin ``foreachBatch`` writes the enriched rows,
  the late rows and the batch metrics, each idempotent per batch id.
Nothing is collected to the driver; write errors fail the batch, so a
batch is committed only after its outputs exist.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tickwise.operators.metrics import batch_metrics
from tickwise.schema import RAW_TICK, conform
from tickwise.sources import sinks
from tickwise.sources.ticks import good_ticks, quarantined
from tickwise.streaming.carried import CarriedEnrichment
from tickwise.streaming.stateful import LATE_HORIZON, enrich_stream


@dataclass
class SinkPaths:
    enriched: str
    late: str
    metrics: str
    raw: str | None = None
    quarantine: str | None = None
    checkpoint: str = ""


def write_enrichment_batch(paths: SinkPaths, enriched_partitions=("date",)):
    """foreachBatch body: persist once, write every output, unpersist."""
    def run(batch: DataFrame, batch_id: int):
        t0 = time.time()
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            good = batch.where(~F.col("late")).drop("late")
            sinks.write_enriched(good, paths.enriched, batch_id=batch_id,
                                 partition_cols=enriched_partitions)
            late = batch.where(F.col("late")).drop("late")
            if not late.isEmpty():
                sinks.write_jsonl(late.withColumn("batch_id", F.lit(batch_id)),
                                  f"{paths.late}/batch_id={batch_id}", mode="overwrite")
            m = (batch_metrics(good.withColumn("batch_id", F.lit(batch_id).cast("long")))
                 .withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
                 .withColumn("elapsed_ms", F.lit(round((time.time() - t0) * 1000.0, 1))))
            sinks.write_jsonl(m, f"{paths.metrics}/batch_id={batch_id}", mode="overwrite")
        finally:
            batch.unpersist()
    return run


def start_enrichment(ticks: DataFrame, paths: SinkPaths, trigger: dict | None = None,
                     watermark: str = "5 minutes", enriched_partitions=("date",),
                     query_name: str | None = None, late_horizon: str = LATE_HORIZON):
    """Start the enrichment query; ``trigger`` e.g. {"processingTime": "10 seconds"}
    or {"availableNow": True}."""
    w = (enrich_stream(ticks, watermark, late_horizon=late_horizon).writeStream
         .foreachBatch(write_enrichment_batch(paths, enriched_partitions))
         .option("checkpointLocation", f"{paths.checkpoint}/enrich"))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return w.start()


def start_raw_archive(decoded: DataFrame, paths: SinkPaths, trigger: dict | None = None):
    """Raw archive through the file sink (exactly-once via its commit log)."""
    raw = decoded.select(*RAW_TICK.fieldNames())
    w = (raw.writeStream.format("parquet").option("path", paths.raw)
         .option("checkpointLocation", f"{paths.checkpoint}/raw").partitionBy("date"))
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def start_quarantine(decoded: DataFrame, paths: SinkPaths, trigger: dict | None = None):
    """Rows that decoding set aside, with the reason and the message as it came."""
    w = (quarantined(decoded).writeStream.format("json").option("path", paths.quarantine)
         .option("checkpointLocation", f"{paths.checkpoint}/quarantine"))
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def start_atomic_ingest(decoded: DataFrame, enrichment: CarriedEnrichment, checkpoint: str,
                        trigger: dict | None = None, after_raw=None):
    """The whole job as one query with one commit per batch: raw archive, quarantine, enriched and late
    rows, corrections, counts and state become visible together (``streaming.manifest``).
    ``after_raw(batch_id)`` is called between two tables of a batch (tests end the job there)."""
    def run(batch: DataFrame, batch_id: int):
        batch = batch.persist()

        def archives(attempt):
            attempt.write("raw", conform(batch, RAW_TICK), ("date",), ("symbol", "event_time"))
            if after_raw:
                after_raw(batch_id)
            attempt.write("quarantine", quarantined(batch))
        try:
            enrichment.run(good_ticks(batch), batch_id, archives)
        finally:
            batch.unpersist()

    return (decoded.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def start_ingest(decoded: DataFrame, paths: SinkPaths, trigger: dict | None = None, **enrichment):
    """The whole job on decoded messages: the raw archive takes every row before
    any filter, rows with a reason go to the quarantine, the rest is enriched."""
    return [start_raw_archive(decoded, paths, trigger), start_quarantine(decoded, paths, trigger),
            start_enrichment(good_ticks(decoded), paths, trigger, **enrichment)]
