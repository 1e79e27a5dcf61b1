"""Data-quality views: latency statistics, histograms, breakdowns,
column profile, completeness, partitions and storage footprint."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickwise.schema import EXPECTED_ANALYTICS_COLS
from tickwise.session import written


RADIX = 1 << 16


def value_at(counts: DataFrame, rank: int) -> float:
    """The value of the 0-based ``rank`` among (x, c): values with their counts, exact.

    Radix selection: the first pass splits by sign and exponent, the next ones split what is left
    of the range into ``RADIX`` equal parts, so a far outlier takes no part of the others' range.
    Each pass sums one row a part (``RADIX`` at most) and keeps the values of one part.
    """
    size = F.floor(F.log2(F.abs("x")))
    part = F.when(F.col("x") == 0, F.lit(0)).otherwise(F.signum("x") * (size + 1100))
    while True:
        parts = sorted((r.p, r.c, r.lo, r.hi) for r in counts.groupBy(part.cast("long").alias("p")).agg(
            F.sum("c").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        for _, c, lo, hi in parts:
            if rank < c:
                break
            rank -= c
        if lo == hi:
            return lo
        counts = counts.where(F.col("x").between(lo, hi))
        half = F.lit(hi / 2 - lo / 2)      # a half, since the whole of a range may not be a double
        part = F.floor((F.col("x") / 2 - F.lit(lo / 2)) / half * (RADIX - 1))


def latency_stats(df: DataFrame, col: str = "latency_ms", q: float = 0.95) -> DataFrame:
    """Mean and P95 (linear interpolation), exact.

    Rows are counted per distinct value; the two neighbouring ranks are found
    by radix selection over these, so no task sorts or gathers them.
    """
    vals = written(df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
                   .groupBy(F.col(col).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("c")), "values")
    whole = vals.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.sum(F.col("x") * F.col("c")).alias("s")).first()
    avg = p = None
    if whole.n:
        pos = (whole.n - 1) * q
        low = value_at(vals, math.floor(pos))
        high = value_at(vals, math.ceil(pos)) if pos != math.floor(pos) else low
        avg, p = whole.s / whole.n, low + (high - low) * (pos - math.floor(pos))
    return df.sparkSession.createDataFrame([(avg, p, whole.n)], "avg_ms double, p95_ms double, n long")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed.

    All ``bins`` bins are returned (empty ones with 0); when min == max
    there is a single bin.
    """
    x = F.col(col).cast("double")
    d = df.where(F.col(col).isNotNull()).select(x.alias("x"))
    rng = d.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    binned = (d.crossJoin(F.broadcast(rng))
               .select(F.when(F.col("hi") == F.col("lo"), F.lit(0))
                        .otherwise(F.least(F.floor((F.col("x") - F.col("lo")) /
                                                   (F.col("hi") - F.col("lo")) * F.lit(float(bins))),
                                           F.lit(bins - 1))).cast("int").alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spine = rng.select("lo", "hi", F.explode(F.sequence(
        F.lit(0), F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.lit(bins - 1)))).alias("bin"))
    return (spine.join(binned, "bin", "left")
                 .select("bin",
                         (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                         (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                         F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def latency_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(df, "latency_ms", bins)


def breakdown(df: DataFrame, col: str = "data_type") -> DataFrame:
    """Value counts with their share of the non-null total."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
                  .select(col, "n", (F.col("n") / F.col("_total")).alias("share")))


def schema_profile(df: DataFrame, order: Sequence[str] = ("event_time", "seq")) -> DataFrame:
    """One row per column: name, type, non-null count, last value (as text).

    One aggregate over the table (``count`` + ``max_by`` per column, on the
    native types), then the one-row result is cast to text and unpivoted.
    """
    o = F.struct(*[F.col(c) for c in order])
    aggs = []
    for f in df.schema.fields:
        aggs.append(F.count(F.col(f.name)).alias(f"n__{f.name}"))
        aggs.append(F.max_by(F.col(f.name), o).alias(f"s__{f.name}"))
    one = df.agg(*aggs)
    parts = []
    for f in df.schema.fields:
        parts += [F.lit(f.name), F.lit(f.dataType.simpleString()),
                  F.col(f"n__{f.name}"), F.col(f"s__{f.name}").cast("string")]
    n = len(df.schema.fields)
    return one.select(F.inline(F.array(*[
        F.struct(parts[4 * i].alias("column_name"), parts[4 * i + 1].alias("dtype"),
                 parts[4 * i + 2].alias("non_null"), parts[4 * i + 3].alias("sample"))
        for i in range(n)])))


def completeness_check(df: DataFrame, expected: Sequence[str] = tuple(EXPECTED_ANALYTICS_COLS)) -> DataFrame:
    """Expected columns with a present flag, plus the table's row count."""
    spark = df.sparkSession
    have = set(df.columns)
    names = spark.createDataFrame([(c, c in have) for c in expected],
                                  "column_name string, present boolean")
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    return names.crossJoin(total)


def column_differences(df: DataFrame, expected: Sequence[str] = tuple(EXPECTED_ANALYTICS_COLS)) -> DataFrame:
    """Columns that are expected and absent, or present and not expected."""
    have = set(df.columns)
    rows = ([(c, "missing") for c in expected if c not in have]
            + [(c, "unexpected") for c in df.columns if c not in set(expected)])
    return df.sparkSession.createDataFrame(rows, "column_name string, difference string")


def partition_listing(df: DataFrame, cols: Sequence[str] = ("date",), key: str = "symbol") -> DataFrame:
    """Distinct partition values with their row and symbol counts."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"),
                                 F.countDistinct(key).alias("symbols"))


def storage_footprint(spark: SparkSession, paths: Sequence[str], glob: str = "*.parquet") -> DataFrame:
    """Files and MB of Parquet trees, read as metadata through ``binaryFile``.

    Only the ``length`` column is projected, so file contents are not read.
    """
    frames = []
    for p in paths:
        frames.append(spark.read.format("binaryFile").option("pathGlobFilter", glob)
                      .option("recursiveFileLookup", "true").load(p)
                      .select(F.lit(p).alias("root"), "length"))
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return (u.groupBy("root").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
             .withColumn("mb", F.round(F.col("bytes") / F.lit(1048576.0), 2)))
