"""Time-axis views: growth per minute, elapsed time, symbol codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickwise.session import written


def growth_per_minute(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """Rows per minute, empty minutes included as 0, with a running total.

    The count is pre-aggregated per minute first; the spine and the
    running total then work on one row per minute of the data's span
    (independent of the row count).  The running total is computed per
    day and offset by the totals of earlier days, so no single window
    holds the whole span.
    """
    return filled_growth(counts_per_minute(df, ts))


def counts_per_minute(df: DataFrame, ts: str = "event_time") -> DataFrame:
    return (df.groupBy(F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz").alias("minute"))
              .agg(F.count(F.lit(1)).alias("count")))


def filled_growth(per_min: DataFrame, lo: str | None = None, hi: str | None = None, before: int = 0) -> DataFrame:
    """Every minute from ``lo`` to ``hi`` (the first and last counted ones) with its count and the
    running total, which starts from ``before``."""
    first, last = (f("minute") if t is None else F.lit(t).cast("timestamp_ntz") for f, t in ((F.min, lo), (F.max, hi)))
    bounds = per_min.agg(first.alias("lo"), last.alias("hi"))
    # two levels: one row per day, then its 1,440 minutes, so no row holds the whole span
    days = bounds.select("lo", "hi", F.explode(F.sequence(
        F.to_date("lo"), F.to_date("hi"))).alias("_day")).repartition("_day")
    spine = (days.select("lo", "hi", "_day", F.explode(F.sequence(F.lit(0), F.lit(1439))).alias("_k"))
                 .select("lo", "hi", (F.col("_day").cast("timestamp_ntz")
                                      + F.make_dt_interval(mins=F.col("_k"))).alias("minute"))
                 .where((F.col("minute") >= F.col("lo")) & (F.col("minute") <= F.col("hi"))).select("minute"))
    filled = (spine.join(per_min, "minute", "left")
                   .select("minute", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
                   .withColumn("_day", F.to_date("minute")))
    day_tot = filled.groupBy("_day").agg(F.sum("count").alias("_dn"))
    day_off = day_tot.withColumn(
        "_off", F.coalesce(F.sum("_dn").over(Window.orderBy("_day").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy("_day").orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    return (filled.join(day_off.select("_day", "_off"), "_day")
                  .withColumn("cumulative", F.col("_off") + F.sum("count").over(w) + F.lit(before))
                  .select("minute", "count", "cumulative"))


def elapsed_seconds(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """Seconds since the first event of the frame (one-row broadcast)."""
    t0 = df.agg(F.min(ts).alias("_t0"))
    return (df.crossJoin(F.broadcast(t0))
              .withColumn("elapsed_s", F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col(ts)) / 1e6)
              .drop("_t0"))


def symbol_ordinal(df: DataFrame, key: str = "symbol") -> DataFrame:
    """0-based code of each distinct symbol in sorted order.

    The symbols are dealt by range and written with the number of their
    range, so that a range stays what it is when a task runs again; they are
    ranked inside their range, and the symbols of earlier ranges are added.
    Ranges are even whatever the symbols have in common.
    """
    d = df.where(F.col(key).isNotNull()).select(key).distinct()
    d = written(d.repartitionByRange(key).select(key, F.spark_partition_id().alias("_p")), "symbols")
    sizes = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_p", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_s"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(key)) - 1
    return d.join(starts, "_p").select(key, (F.col("_s") + rank).cast("long").alias("symbol_ordinal"))


def symbol_codes(df: DataFrame, key: str = "symbol") -> DataFrame:
    """The rows with their symbol's code; rows without a symbol have none."""
    return df.join(symbol_ordinal(df, key), key, "left")
