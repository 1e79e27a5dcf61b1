"""Streaming enrichment whose state is tables: carries between micro-batches.

Every micro-batch is a batch job.  For each symbol that it touches, the last
``KEEP`` rows of the series and the running sums at its end (the *carry*) are
put before the new rows, and the indicators come from the same window
expressions as in ``operators.enrich``; the new end of the series becomes the
next batch's state.  Carries are associative (sums of price x volume, of volume
and of differences, decayed gain and loss sums), so the rows of a hot symbol are
cut into blocks, each block is worked on alone, and the carries of the blocks
are combined afterwards: no task holds a symbol.

Order and lateness:

* A row waits until an event time ``delay`` later than its own was seen; rows
  that wait are a table, too.  ``flush`` emits them without later input.
* A late row (older than what its symbol has emitted) is put where it belongs:
  the series is taken up again at the row before it.  The late row goes to
  ``late`` with the indicators of its place; rows after it whose values change
  go to ``corrections``, and ``read_series`` applies the newest version.
* A row whose (symbol, event time, seq) was there before is a repeat and left out.

State is written for the touched symbols only; every ``FULL_EVERY`` batches it
is written whole, so that a reader opens a bounded number of folders.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickwise.functions import indicators as ind
from tickwise.functions.numeric import safe_div
from tickwise.operators.enrich import rsi_carry, usable, with_defaults, with_flags
from tickwise.operators.split_enrich import HALO, global_row_number
from tickwise.schema import ENRICHED_TICK, conform
from tickwise.streaming.manifest import Attempt, Store

KEEP = 50                 # rows of each series in the state; the widest frame needs HALO
FULL_EVERY = 20
BLOCK_ROWS = 1_000_000
ORDER = ("event_time", "seq")
KEY = ("symbol", *ORDER)
CARRY = {"c_pv": "decimal(38,0)", "c_v": "decimal(38,0)", "c_nd": "long", "c_g": "double", "c_l": "double"}
TICK = [f.name for f in ENRICHED_TICK.fields if f.name not in {
    "moving_avg_5", "moving_avg_20", "volatility", "rsi_14", "vwap", "volume_trend", "price_change_pct",
    "crash_score", "latency_ms"}]
_FIELDS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ENRICHED_TICK.fields)
SERIES_SCHEMA = _FIELDS + "".join(f", {c} {t}" for c, t in CARRY.items())
TICK_SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ENRICHED_TICK.fields if f.name in TICK)
VERSIONED = SERIES_SCHEMA + ", batch_id long"


def _no_carry():
    return [F.lit(None).cast(t).alias(c) for c, t in CARRY.items()]


def advance(frame: DataFrame, block_rows: int = BLOCK_ROWS, rsi_block: int | None = None, periods: int = 14,
            price_scale: int = 2, crash: ind.CrashRule = ind.CrashRule(), work: str | None = None,
            longest: int | None = None) -> DataFrame:
    """Indicators and carries of the rows of ``frame`` that aren't ``tail`` rows.

    ``frame`` has the tick columns, ``tail`` (rows already emitted, which only fill frames) and the
    ``CARRY`` columns, set on the newest tail row of a symbol.  Symbols of more than ``block_rows`` new
    rows are cut into blocks; these need ``work``, a folder for the blocks' rows.
    ``longest``, the most new rows of a symbol, is counted if it isn't given.
    """
    block = rsi_block or ind.rsi_block_rows(periods)
    real = frame.where(~F.col("tail"))
    if longest is None:
        longest = real.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    hot = longest > block_rows
    if hot:
        # blocks of rows, each with the rows before it that its frames reach
        numbered = global_row_number(real)
        g = F.floor((F.col("_rn") - 1) / block_rows).cast("long")
        near_end = (F.col("_rn") - 1) % block_rows >= block_rows - HALO
        numbered = (numbered.withColumn("_own", g)
                    .withColumn("_g", F.explode(F.when(near_end, F.array(g, g + 1)).otherwise(F.array(g))))
                    .withColumn("tail", F.col("_g") != F.col("_own")).drop("_own", "_rn"))
        x = numbered.unionByName(frame.where("tail").withColumn("_g", F.lit(0).cast("long")))
    else:
        x = frame.withColumn("_g", F.lit(0).cast("long"))

    own = ~F.col("tail")
    w = Window.partitionBy("symbol", "_g").orderBy(*ORDER)
    run, whole = ind.running(w), Window.partitionBy("symbol", "_g")
    d = F.col("close") - F.lag("close").over(w)
    pv, v = ind.vwap_terms("close", "volume", price_scale)
    x = x.select(
        "*",
        ind.moving_avg("close", w, 5, price_scale).alias("moving_avg_5"),
        ind.moving_avg("close", w, 20, price_scale).alias("moving_avg_20"),
        ind.volatility("close", w, 5, price_scale).alias("volatility"),
        ind.volume_trend("volume", w, 5).alias("volume_trend"),
        ind.price_change_pct("open", "close", price_scale).alias("price_change_pct"),
        F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))).alias("_gain"),
        F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0))).alias("_loss"),
        F.sum(F.when(own, pv)).over(run).alias("_pv"), F.sum(F.when(own, v)).over(run).alias("_v"),
        F.count(F.when(own & d.isNotNull(), F.lit(1))).over(run).alias("_nd"),
        (F.count(F.when(own, F.lit(1))).over(run) - 1).alias("_k"),
        *[F.max(c).over(whole).alias(f"_in_{c}") for c in CARRY]).where(own)
    # gains and losses weighted from the start of their sub-block, then in units of the row itself
    x = (x.withColumn("_r", F.floor(F.col("_k") / block).cast("long"))
          .withColumn("_j", (F.col("_k") - F.col("_r") * block).cast("double")))
    x = x.withColumn("_wt", F.pow(F.lit(ind.rsi_growth(periods)), F.col("_j")))
    inner = ind.running(Window.partitionBy("symbol", "_g", "_r").orderBy(*ORDER))
    x = x.select("*", F.sum(F.col("_gain") * F.col("_wt")).over(inner).alias("_gi"),
                 F.sum(F.col("_loss") * F.col("_wt")).over(inner).alias("_li"))
    total = F.when(F.col("_j") == block - 1, F.struct("_r", F.col("_gi").alias("_g"), F.col("_li").alias("_l")))
    before = Window.partitionBy("symbol", "_g").orderBy("_r").rangeBetween(-ind.rsi_carry_lags(periods, block), -1)
    x = x.withColumn("_t", total).withColumn("_t", F.collect_list("_t").over(before))
    cg, cl = rsi_carry(F.col("_t"), ind.rsi_decay(periods, block))
    zero = F.lit(0.0)
    x = (x.withColumn("_gl", (cg + F.coalesce("_gi", zero)) / F.col("_wt"))
          .withColumn("_ll", (cl + F.coalesce("_li", zero)) / F.col("_wt"))
          .drop("_t", "_r", "_j", "_wt", "_gi", "_li", "_gain", "_loss"))
    if hot:
        x.write.parquet(work)
        x = frame.sparkSession.read.schema(x.schema).parquet(work)
        x = x.drop(*[f"_in_{c}" for c in CARRY]).join(_block_carries(x, periods), ["symbol", "_g"])

    nothing = F.lit(0)
    fade = F.pow(F.lit(1.0 / ind.rsi_growth(periods)), (F.col("_k") + 1).cast("double"))
    x = x.withColumns({
        "c_pv": (F.coalesce("_in_c_pv", nothing.cast("decimal(38,0)")) + F.coalesce("_pv", nothing)).cast("decimal(38,0)"),
        "c_v": (F.coalesce("_in_c_v", nothing.cast("decimal(38,0)")) + F.coalesce("_v", nothing)).cast("decimal(38,0)"),
        "c_nd": F.coalesce("_in_c_nd", nothing.cast("long")) + F.col("_nd"),
        "c_g": F.coalesce("_in_c_g", zero) * fade + F.col("_gl"),
        "c_l": F.coalesce("_in_c_l", zero) * fade + F.col("_ll")})
    units = F.when(F.col("volume").isNotNull(), safe_div(F.col("c_pv"), F.col("c_v")))
    x = (x.withColumn("vwap", ind.units_to_2dp(units, price_scale))
          .withColumn("rsi_14", ind.rsi_from_sums(F.col("c_g"), F.col("c_l"), F.col("c_nd"), periods)))
    return with_flags(x, crash).drop("_g", "_pv", "_v", "_nd", "_k", "_gl", "_ll", "tail", *[f"_in_{c}" for c in CARRY])


def _block_carries(x: DataFrame, periods: int) -> DataFrame:
    """(symbol, _g) -> the carry that the block starts with: the state's, then block after block.
    One row a block; a symbol's blocks are one array of a few numbers each."""
    w = Window.partitionBy("symbol", "_g").orderBy(F.desc("_k"))
    last = x.withColumn("_p", F.row_number().over(w)).where("_p = 1")
    zero = F.lit(0).cast("decimal(38,0)")
    ends = last.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct(
            "_g", (F.col("_k") + 1).cast("double").alias("n"), F.coalesce("_pv", zero).cast("decimal(38,0)").alias("pv"),
            F.coalesce("_v", zero).cast("decimal(38,0)").alias("v"), "_nd", "_gl", "_ll"))).alias("ends"),
        *[F.max(f"_in_{c}").alias(f"_in_{c}") for c in CARRY])
    start = F.array(F.struct(
        F.lit(-1).cast("long").alias("g"), F.coalesce("_in_c_pv", zero).cast("decimal(38,0)").alias("pv"),
        F.coalesce("_in_c_v", zero).cast("decimal(38,0)").alias("v"),
        F.coalesce("_in_c_nd", F.lit(0)).cast("long").alias("nd"), F.coalesce("_in_c_g", F.lit(0.0)).alias("gain"),
        F.coalesce("_in_c_l", F.lit(0.0)).alias("loss")))
    q = F.lit(1.0 / ind.rsi_growth(periods))

    def follow(done, e):
        p = F.element_at(done, -1)
        fade = F.pow(q, e["n"])
        return F.concat(done, F.array(F.struct(
            e["_g"].alias("g"), (p["pv"] + e["pv"]).cast("decimal(38,0)").alias("pv"),
            (p["v"] + e["v"]).cast("decimal(38,0)").alias("v"), (p["nd"] + e["_nd"]).alias("nd"),
            (p["gain"] * fade + e["_gl"]).alias("gain"), (p["loss"] * fade + e["_ll"]).alias("loss"))))

    each = ends.select("symbol", F.explode(F.aggregate("ends", start, follow)).alias("c"))
    return each.select("symbol", (F.col("c.g") + 1).alias("_g"), F.col("c.pv").alias("_in_c_pv"),
                       F.col("c.v").alias("_in_c_v"), F.col("c.nd").alias("_in_c_nd"),
                       F.col("c.gain").alias("_in_c_g"), F.col("c.loss").alias("_in_c_l"))


def series_end(rows: DataFrame, keep: int = KEEP) -> DataFrame:
    """The last ``keep`` rows of every symbol: the state that its next rows need."""
    w = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in ORDER])
    return rows.withColumn("_p", F.row_number().over(w)).where(F.col("_p") <= keep).drop("_p")


def state_of(ticks: DataFrame, **options) -> DataFrame:
    """The state after a finished history of ticks, for a warm start."""
    fresh = conform(with_defaults(usable(ticks)), ENRICHED_TICK).select(*TICK, F.lit(False).alias("tail"), *_no_carry())
    return series_end(advance(fresh, **options)).select(*[f.name for f in ENRICHED_TICK.fields], *CARRY)


class CarriedEnrichment:
    """The enrichment of one stream in one ``Store``; ``run`` is a foreachBatch body."""

    def __init__(self, spark: SparkSession, root: str, delay: str = "5 minutes", block_rows: int = BLOCK_ROWS,
                 rsi_block: int | None = None, rows_per_file: int | None = None, periods: int = 14,
                 crash: ind.CrashRule = ind.CrashRule()):
        from tickwise.streaming.stateful import interval_ms
        self.spark = spark
        self.store = Store(spark, root, **({"rows_per_file": rows_per_file} if rows_per_file else {}))
        self.delay = dt.timedelta(milliseconds=interval_ms(delay))
        self.options = {"block_rows": block_rows, "rsi_block": rsi_block, "periods": periods, "crash": crash}

    # -- state ---------------------------------------------------------------

    def warm_start(self, state: DataFrame) -> None:
        """Begin with the end of an earlier history (``state_of``, or another store's ``state``)."""
        if self.store.last() is not None:
            raise RuntimeError("the store has batches already")
        attempt = self.store.attempt(-1)
        newest = state.agg(F.max("event_time")).first()[0]
        attempt.write("state", state.select(*[f.name for f in ENRICHED_TICK.fields], *CARRY))
        attempt.commit(newest=newest and newest.isoformat(), full=True)

    def state(self) -> DataFrame:
        """The last ``KEEP`` rows of every symbol with their indicators, and the carries."""
        return self._state(self.store.commits())

    def _state(self, commits) -> DataFrame:
        since = max((i for i, c in enumerate(commits) if c.facts.get("full")), default=0)
        paths = [(i, p) for i, c in enumerate(commits[since:]) for p in c.tables.get("state", [])]
        if not paths:
            return self.spark.createDataFrame([], SERIES_SCHEMA)
        parts = [self.store.read("state", SERIES_SCHEMA, [p]).withColumn("_v", F.lit(i)) for i, p in paths]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        newest = every.groupBy("symbol").agg(F.max("_v").alias("_v"))
        return every.join(newest, ["symbol", "_v"]).drop("_v")

    # -- one batch -----------------------------------------------------------

    def run(self, batch: DataFrame, batch_id: int, extra=None) -> None:
        """Process one micro-batch of ticks.  ``extra(attempt)`` may write further tables of the batch."""
        if self.store.has(batch_id):
            return            # committed, though Spark didn't get to note it
        self._step(batch, self.store.attempt(batch_id), flush=False, extra=extra)

    def flush(self) -> None:
        """Emit the rows that wait for later event times: the input has ended."""
        last = self.store.last()
        if last is not None and last.step == 0:
            empty = self.spark.createDataFrame([], TICK_SCHEMA)
            self._step(empty, self.store.attempt(last.batch, 1), flush=True)

    def _step(self, batch: DataFrame, attempt: Attempt, flush: bool, extra=None) -> None:
        spark, store, commits = self.spark, self.store, self.store.commits()
        last = commits[-1] if commits else None
        arrived = conform(with_defaults(usable(batch)), ENRICHED_TICK).select(*TICK)
        arrived.write.parquet(attempt.scratch("arrived"))
        arrived = spark.read.schema(arrived.schema).parquet(attempt.scratch("arrived"))
        if last is not None and last.tables.get("pending"):
            waiting = store.read("pending", TICK_SCHEMA, last.tables["pending"]).select(*TICK)
            arrived = waiting.unionByName(arrived)
        newest = arrived.agg(F.max("event_time")).first()[0]
        known = last and last.facts.get("newest") and dt.datetime.fromisoformat(last.facts["newest"])
        newest = max((t for t in (newest, known) if t is not None), default=None)
        due = F.lit(True) if flush or newest is None else (
            F.col("event_time") <= F.lit((newest - self.delay).isoformat()).cast("timestamp_ntz"))

        state = self._state(commits)
        ends = state.groupBy("symbol").agg(F.max(F.struct(*ORDER)).alias("end"))
        place = F.struct(*ORDER)
        marked = (arrived.where(due).dropDuplicates(list(KEY)).join(ends, "symbol", "left")
                  .withColumn("late", F.coalesce(place <= F.col("end"), F.lit(False))).drop("end"))
        marked.write.parquet(attempt.scratch("due"))
        marked = spark.read.schema(marked.schema).parquet(attempt.scratch("due"))
        counts = (marked.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_if("late").alias("late"))
                  .agg(F.sum("n").alias("n"), F.sum("late").alias("late"), F.max("n").alias("longest")).first())

        if counts.n:
            frame = self._frame(marked, state, commits, bool(counts.late))
            longest = counts.longest
            if counts.late or longest > self.options["block_rows"]:
                # read more than once, or made from the whole series
                frame.write.parquet(attempt.scratch("frame"))
                frame, longest = spark.read.schema(frame.schema).parquet(attempt.scratch("frame")), None
            done = advance(frame, work=attempt.scratch("blocks"), longest=longest, **self.options)
            done = done.select(*[f.name for f in ENRICHED_TICK.fields], *CARRY, "kind")
            done.write.parquet(attempt.scratch("done"))
            done = spark.read.schema(done.schema).parquet(attempt.scratch("done"))
            self._write(attempt, done, state, commits, bool(counts.late))
        pending = arrived.where(~due) if not flush else None
        if pending is not None:
            attempt.write("pending", pending)
        if extra is not None:
            extra(attempt)
        attempt.commit(newest=newest and newest.isoformat(), full=attempt.full)

    def _frame(self, due: DataFrame, state: DataFrame, commits, late: bool) -> DataFrame:
        """Rows to work on: new ones, the ends of their series, and for symbols with late rows the
        series from the row before the first of them."""
        none = _no_carry()
        columns = [*TICK, "kind", "tail", *CARRY]
        new = due.where(~F.col("late")).select(*TICK, F.lit("new").alias("kind"), F.lit(False).alias("tail"), *none)
        touched = new.select("symbol").distinct()
        if late:
            first = due.where("late").groupBy("symbol").agg(F.min(F.struct(*ORDER)).alias("first"))
            series = read_series(self.store, commits).join(first, "symbol")
            old = series.where(F.struct(*ORDER) >= F.col("first"))       # the first late row may be a repeat
            came = due.where("late").join(old.select(*KEY), list(KEY), "left_anti")
            tails = series_end(series.where(F.struct(*ORDER) < F.col("first")))
            rest = touched.join(first, "symbol", "left_anti")
            new = new.unionByName(came.select(*TICK, F.lit("late").alias("kind"), F.lit(False).alias("tail"), *none))
            new = new.unionByName(old.select(*TICK, F.lit("old").alias("kind"), F.lit(False).alias("tail"), *none))
            tails = tails.select(*TICK, *CARRY).unionByName(
                state.join(rest, "symbol", "left_semi").select(*TICK, *CARRY))
        else:
            tails = state.join(touched, "symbol", "left_semi").select(*TICK, *CARRY)
        # the carry of a series is that of its newest row
        w = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in ORDER])
        tails = tails.withColumn("_p", F.row_number().over(w)).select(
            *TICK, F.lit("tail").alias("kind"), F.lit(True).alias("tail"),
            *[F.when(F.col("_p") == 1, F.col(c)).alias(c) for c in CARRY])
        return new.select(*columns).unionByName(tails.select(*columns))

    def _write(self, attempt: Attempt, done: DataFrame, state: DataFrame, commits, late: bool) -> None:
        rows = [f.name for f in ENRICHED_TICK.fields]
        order = ("symbol", *ORDER)
        attempt.write("enriched", done.where("kind = 'new'").select(*rows, *CARRY), ("date",), order)
        if late:
            attempt.write("late", done.where("kind = 'late'").select(*rows, *CARRY), ("date",), order)
            # all carries after a late row are new; a correction is needed for each, so that later late rows start right
            attempt.write("corrections", done.where("kind = 'old'").select(*rows, *CARRY), ("date",), order)
        per = done.where("kind <> 'old'").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
        attempt.write("metrics", per)
        # the series' ends: rows before this batch's fill up to KEEP
        kept = state.join(done.select("symbol").distinct(), "symbol", "left_semi")
        kept = kept.join(done.select(*KEY), list(KEY), "left_anti")
        ends = series_end(kept.select(*rows, *CARRY).unionByName(done.select(*rows, *CARRY)))
        attempt.full = len(commits) - max((i for i, c in enumerate(commits) if c.facts.get("full")), default=0) >= FULL_EVERY
        if attempt.full:
            ends = ends.unionByName(state.join(done.select("symbol").distinct(), "symbol", "left_anti").select(*ends.columns))
        attempt.write("state", ends)


def read_series(store: Store, commits=None) -> DataFrame:
    """Enriched and late rows with the newest correction of each; carries included."""
    commits = store.commits() if commits is None else commits
    parts = [store.read(t, VERSIONED, [p for c in commits for p in c.tables.get(t, [])])
             for t in ("enriched", "late", "corrections")]
    every = parts[0].unionByName(parts[1])
    if not any(c.tables.get("corrections") for c in commits):
        return every.drop("batch_id")
    every = every.unionByName(parts[2])
    newest = Window.partitionBy(*KEY).orderBy(F.desc("batch_id"))
    return every.withColumn("_p", F.row_number().over(newest)).where("_p = 1").drop("_p", "batch_id")


def read_enriched(store: Store, corrected: bool = True) -> DataFrame:
    """The enriched table as readers see it; without ``corrected``, rows as they were first emitted."""
    rows = [f.name for f in ENRICHED_TICK.fields]
    if corrected:
        return read_series(store).select(*rows)
    return store.read("enriched", SERIES_SCHEMA).select(*rows)


def batch_rows(store: Store) -> DataFrame:
    """(batch_id, symbol, n): rows that each batch emitted."""
    return store.read("metrics", "symbol string, n long, batch_id long").select("batch_id", "symbol", "n")


def start(ticks: DataFrame, enrichment: CarriedEnrichment, checkpoint: str, trigger: dict | None = None):
    """Run the enrichment on a stream of ticks."""
    return (ticks.writeStream.foreachBatch(enrichment.run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def describe(store: Store) -> str:
    """The commits as JSON lines, for inspection."""
    return "\n".join(json.dumps(c.__dict__) for c in store.commits())
