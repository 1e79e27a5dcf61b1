import pytest
from pyspark.sql import functions as F

from tickwise.operators.enrich import enrich
from tickwise.plans import catalog
from tickwise.schema import ENRICHED_TICK
from tickwise.streaming import carried

SF = "/root/testdata/sf0.001"
COLS = [f.name for f in ENRICHED_TICK.fields]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


@pytest.fixture(scope="module")
def ticks(spark):
    t = catalog.ticks(spark, SF).select(*catalog.STREAM_COLS)
    # few symbols, so that series are long enough to be cut; one of them holds half of the rows
    name = F.when(F.col("seq") % 2 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("seq") % 7))
    gaps = t.withColumn("symbol", name).withColumn("volume", F.when(F.col("seq") % 9 != 0, F.col("volume")))
    path = catalog.scratch(spark, "carried-ticks")
    gaps.write.parquet(path)
    return spark.read.parquet(path)


def slices(ticks, n):
    """Batches by event time, each of which also holds rows of the next minutes."""
    times = sorted(r[0] for r in ticks.select("event_time").distinct().collect())
    edges = [times[len(times) * k // n] for k in range(1, n)]
    before = None
    for e in [*edges, None]:
        cond = F.lit(True) if e is None else F.col("event_time") < F.lit(str(e)).cast("timestamp_ntz")
        yield ticks.where(cond & (F.lit(True) if before is None else F.col("event_time") >= F.lit(str(before)).cast("timestamp_ntz")))
        before = e


def run(spark, batches, **options):
    e = carried.CarriedEnrichment(spark, catalog.scratch(spark, "carried"), **options)
    for i, b in enumerate(batches):
        e.run(b, i)
        e.run(b, i)          # a batch that Spark runs again changes nothing
    e.flush()
    return e


@pytest.mark.parametrize("options", [{}, {"block_rows": 60, "rsi_block": 20}])
def test_batches_equal_one_batch(spark, ticks, options):
    want = rows(enrich(ticks))
    e = run(spark, slices(ticks, 3), **options)
    assert rows(carried.read_enriched(e.store)) == want
    assert rows(carried.read_enriched(e.store, corrected=False)) == want
    per = carried.batch_rows(e.store).groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    assert {r.symbol: r.n for r in per} == {r.symbol: r["count"] for r in ticks.groupBy("symbol").count().collect()}
    # the state is the end of every series
    assert rows(e.state()) == rows(carried.series_end(enrich(ticks)))


def test_warm_start(spark, ticks):
    first, last = slices(ticks, 2)
    e = carried.CarriedEnrichment(spark, catalog.scratch(spark, "warm"))
    e.warm_start(carried.state_of(first))
    e.run(last, 0)
    e.flush()
    new = enrich(ticks).join(last.select("seq"), "seq", "left_semi")
    assert rows(carried.read_enriched(e.store)) == rows(new)
    with pytest.raises(RuntimeError):
        e.warm_start(carried.state_of(first))


def test_late_rows_take_their_place(spark, ticks):
    late = ticks.where("seq % 50 IN (3, 4)")
    on_time = ticks.join(late.select("seq"), "seq", "left_anti").select(*ticks.columns)
    e = run(spark, [*slices(on_time, 2), late.unionByName(late), late.limit(0), late], block_rows=100, rsi_block=20)
    want = rows(enrich(ticks))
    assert rows(carried.read_enriched(e.store)) == want
    first = carried.read_enriched(e.store, corrected=False)
    assert first.count() == on_time.count() and rows(first) != want
    assert e.store.read("late", carried.SERIES_SCHEMA).count() == late.count()


def test_files_are_planned_and_failed_attempts_unseen(spark, ticks):
    e = carried.CarriedEnrichment(spark, catalog.scratch(spark, "files"), rows_per_file=40)

    def fail(attempt):
        raise RuntimeError("lost between two tables")
    with pytest.raises(RuntimeError, match="lost"):
        e.run(ticks, 0, fail)
    assert e.store.last() is None and e.store.read("enriched", carried.SERIES_SCHEMA).count() == 0
    e.run(ticks, 0)
    e.flush()
    assert rows(carried.read_enriched(e.store)) == rows(enrich(ticks))
    # a date of a batch has no more files than its rows need
    per = (spark.read.option("basePath", f"{e.store.root}/enriched").parquet(*[f"{e.store.root}/{p}" for p in e.store.paths("enriched")])
           .select("batch_id", "attempt", "date", F.input_file_name().alias("file"))
           .groupBy("batch_id", "attempt", "date").agg(F.countDistinct("file").alias("files"), F.count("*").alias("n")).collect())
    assert per and all(r.files <= -(-r.n // 40) for r in per)
