import datetime as dt

from pyspark.sql import functions as F

from tickwise.plans import catalog
from tickwise.streaming.growth import CarriedGrowth

T0 = dt.datetime(2024, 1, 1, 23, 50)


def frame(spark, minutes):
    return spark.createDataFrame([(T0 + dt.timedelta(minutes=m),) for m in minutes], "event_time timestamp_ntz")


def seen(df):
    return [((r.minute - T0).total_seconds() / 60, r["count"], r.cumulative) for r in df.orderBy("minute").collect()]


def test_gaps_totals_late_rows_and_restarts(spark):
    root = catalog.scratch(spark, "growth-test")
    g = CarriedGrowth(spark, root, delay="5 minutes")
    g.run(frame(spark, [0, 0, 3]), 0)                  # nothing is five minutes old yet
    assert seen(g.read()) == []
    g.run(frame(spark, [14, 1, 4.5]), 1)
    g.run(frame(spark, [14, 1, 4.5]), 1)               # run again by Spark
    want = [(0, 2, 2), (1, 1, 3), (2, 0, 3), (3, 1, 4), (4, 1, 5), (5, 0, 5), (6, 0, 5), (7, 0, 5), (8, 0, 5)]
    assert seen(g.read()) == want
    g = CarriedGrowth(spark, root, delay="5 minutes")  # a new process goes on
    g.run(frame(spark, [2, 2, 16]), 2)                 # two late rows
    assert seen(g.read(corrected=False)) == [*want, (9, 0, 5), (10, 0, 5)]
    g.run(frame(spark, []), 3)
    g.flush()
    g.flush()
    emitted = seen(g.read(corrected=False))
    assert emitted[-3:] == [(14, 1, 6), (15, 0, 6), (16, 1, 7)] and [m for m, *_ in emitted] == list(range(17))
    corrected = seen(g.read())
    assert corrected[2] == (2, 2, 5) and corrected[-1] == (16, 1, 9)
    assert g.store.read("late", "minute timestamp_ntz, count long").agg(F.sum("count")).first()[0] == 2
