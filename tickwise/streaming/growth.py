"""Rows per event-time minute as a stream: empty minutes, running total, late rows.

A minute is emitted once an event time ``delay`` past its end was seen; minutes
without a row come out as zero, and the running total goes on from batch to
batch.  Rows of minutes that were emitted before are counted in a table of their
own, so no row vanishes; ``read`` adds them to their minutes and to the totals
from there on.  What a batch carries over is one row a minute: counts of minutes
that are still open, and in its commit the last minute and the total.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwise.operators.timeseries import counts_per_minute, filled_growth
from tickwise.streaming.manifest import Store
from tickwise.streaming.stateful import interval_ms

COUNTS = "minute timestamp_ntz, count long"
MINUTE = dt.timedelta(minutes=1)


class CarriedGrowth:
    """Minute counts of one stream in one ``Store``; ``run`` is a foreachBatch body."""

    def __init__(self, spark: SparkSession, root: str, delay: str = "5 minutes"):
        self.spark, self.store = spark, Store(spark, root)
        self.delay = dt.timedelta(milliseconds=interval_ms(delay))

    def run(self, batch: DataFrame, batch_id: int) -> None:
        if not self.store.has(batch_id):
            rows = batch.where(F.col("event_time").isNotNull())
            self._step(counts_per_minute(rows), rows, self.store.attempt(batch_id), flush=False)

    def flush(self) -> None:
        """Emit the open minutes: the input has ended."""
        last = self.store.last()
        if last is not None and last.step == 0:
            self._step(self.spark.createDataFrame([], COUNTS), None, self.store.attempt(last.batch, 1), flush=True)

    def _step(self, counts: DataFrame, rows: DataFrame | None, attempt, flush: bool) -> None:
        last = self.store.last()
        facts = last.facts if last else {}
        upto, newest = (facts.get(k) and dt.datetime.fromisoformat(facts[k]) for k in ("upto", "newest"))
        total = facts.get("total", 0)
        if rows is not None:
            seen = rows.agg(F.max("event_time")).first()[0]
            newest = max((t for t in (seen, newest) if t is not None), default=None)
        if last and last.tables.get("open"):
            counts = counts.unionByName(self.store.read("open", COUNTS, last.tables["open"]))
        counts = counts.groupBy("minute").agg(F.sum("count").alias("count"))
        counts.write.parquet(attempt.scratch("counts"))
        counts = self.spark.read.schema(COUNTS).parquet(attempt.scratch("counts"))

        def at(t):
            return F.lit(t.isoformat()).cast("timestamp_ntz")

        late = F.col("minute") <= at(upto) if upto else F.lit(False)
        fresh = counts.where(~late)
        attempt.write("late", counts.where(late))
        if newest is not None:
            # the last minute that lies whole before the newest event time less the delay
            edge = newest if flush else newest - self.delay - MINUTE
            close = edge.replace(second=0, microsecond=0)
            done = fresh.where(F.col("minute") <= at(close))
            first = (upto + MINUTE) if upto else done.agg(F.min("minute")).first()[0]
            if first is not None and first <= close:
                attempt.write("minutes", filled_growth(done, first.isoformat(), close.isoformat(), total))
                total += done.agg(F.sum("count")).first()[0] or 0
                upto = close
            fresh = fresh.where(F.col("minute") > at(close))
        attempt.write("open", fresh)
        attempt.commit(newest=newest and newest.isoformat(), upto=upto and upto.isoformat(), total=total)

    def read(self, corrected: bool = True) -> DataFrame:
        """(minute, count, cumulative) as emitted, or with the late rows in their minutes."""
        minutes = self.store.read("minutes", COUNTS + ", cumulative long")
        if not corrected:
            return minutes
        late = self.store.read("late", COUNTS)
        counts = minutes.select("minute", "count").unionByName(late)
        return filled_growth(counts.groupBy("minute").agg(F.sum("count").alias("count")))


def start(ticks: DataFrame, growth: CarriedGrowth, checkpoint: str, trigger: dict | None = None):
    return (ticks.writeStream.foreachBatch(growth.run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
