"""What the streams write on the way: slices of several files, no table that is read once."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickwise.plans import catalog
from tickwise.streaming.carried import TICK_SCHEMA, CarriedEnrichment, read_enriched
from tickwise.streaming.manifest import Attempt


def test_slices_of_the_ingest_are_dealt_to_several_files(spark):
    store = catalog._atomic_ingest(spark, SF_SMALL).store
    files = glob.glob(f"{os.path.dirname(store.root)}/in/part-*")
    assert len(files) == 3 * catalog.FILES
    assert [c.batch for c in store.commits() if c.step == 0] == [0, 1, 2]
    good = catalog.messages(spark, SF_SMALL).where("seq % 13 > 0 AND seq % 17 > 0 AND seq % 19 > 0").count()
    assert read_enriched(store).count() == good


def ticks(spark, minutes, seq0):
    t0 = dt.datetime(2024, 1, 2, 9)
    rows = [("A", 100.0, 100.0 + m % 3, 10, t0 + dt.timedelta(minutes=m), seq0 + m, 0, t0.date()) for m in minutes]
    df = spark.createDataFrame(rows, "symbol string, open double, close double, volume long, event_time timestamp_ntz, "
                                     "seq long, spark_process_time long, date date")
    have = set(df.columns)
    parts = [p.strip().split(" ", 1) for p in TICK_SCHEMA.split(", ")]
    return df.select(*[F.col(n) if n in have else F.lit(None).cast(k).alias(n) for n, k in parts])


def test_only_batches_with_late_rows_write_their_frame(spark, tmp_path, monkeypatch):
    asked, scratch = [], Attempt.scratch

    def noted(self, name):
        asked.append((self.batch, name))
        return scratch(self, name)

    monkeypatch.setattr(Attempt, "scratch", noted)
    e = CarriedEnrichment(spark, str(tmp_path / "store"))
    e.run(ticks(spark, [0, 1, 2, 10, 20], 0), 0)
    e.run(ticks(spark, [21, 40], 0), 1)
    e.run(ticks(spark, [5, 41, 50], 0), 2)       # minute 5 is late
    e.flush()
    assert {b for b, name in asked if name == "frame"} == {2}
    got = [r.seq for r in read_enriched(e.store).orderBy("event_time").collect()]
    assert got == [0, 1, 2, 5, 10, 20, 21, 40, 41, 50]
