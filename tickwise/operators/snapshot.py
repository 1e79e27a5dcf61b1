"""Per-symbol snapshots and row selections over the enriched table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

ORDER = ("event_time", "seq")


def _order_struct():
    return F.struct(*[F.col(c) for c in ORDER])


def latest_per_symbol(df: DataFrame, mode: str = "non_null", key: str = "symbol") -> DataFrame:
    """Most recent values per symbol.

    ``mode="non_null"``: for every column the last non-null value in
    (event_time, seq) order - values may come from different rows, as a
    pandas ``groupby().last()`` gives.  This is a hash aggregate with
    ``max_by`` so map-side partial aggregation keeps the shuffle at one
    row per symbol and task, however hot a symbol is.
    ``mode="row"``: the whole last row (``row_number`` top-1, which Spark
    plans as a per-partition group limit before the exchange).
    """
    cols = [c for c in df.columns if c != key]
    if mode == "row":
        w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in ORDER])
        return (df.withColumn("_rn", F.row_number().over(w))
                  .where(F.col("_rn") == 1).drop("_rn"))
    if mode != "non_null":
        raise ValueError(f"unknown mode {mode!r}")
    o = _order_struct()
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c) for c in cols]
    return df.groupBy(key).agg(*aggs)


def tail_per_symbol(df: DataFrame, n: int = 3, key: str = "symbol",
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Last ``n`` rows of each symbol with their position from the end (1 = newest)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in ORDER])
    out = (df.withColumn("pos_from_end", F.row_number().over(w).cast("long"))
             .where(F.col("pos_from_end") <= n))
    if columns:
        out = out.select(key, *[c for c in columns if c != key], "pos_from_end")
    return out


def recent_window(df: DataFrame, minutes: int, ts: str = "event_time") -> DataFrame:
    """Rows within ``minutes`` of the data's latest event time (inclusive).

    The one-row max is broadcast (its size is one row by construction).
    ``minutes <= 0`` keeps everything.
    """
    if minutes <= 0:
        return df
    mx = df.agg(F.max(ts).alias("_max_ts"))
    return (df.crossJoin(F.broadcast(mx))
              .where(F.col(ts) >= F.col("_max_ts") - F.make_dt_interval(mins=F.lit(minutes)))
              .drop("_max_ts"))


def filter_sector_symbol(df: DataFrame, sectors: Sequence[str] = (),
                         symbols: Sequence[str] = ()) -> DataFrame:
    """Sector IN / symbol IN; an empty selection means no filter."""
    if sectors:
        df = df.where(F.col("sector").isin(list(sectors)))
    if symbols:
        df = df.where(F.col("symbol").isin(list(symbols)))
    return df


def recent_rows(df: DataFrame, n: int = 500, order: Sequence[str] = ORDER) -> DataFrame:
    """The newest ``n`` rows overall, oldest of them first (a top-k: each task
    keeps only n rows; the second sort sees those n)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def sector_default(df: DataFrame, value: str = "Unknown") -> DataFrame:
    """Missing or null sector -> ``value``."""
    if "sector" not in df.columns:
        return df.withColumn("sector", F.lit(value))
    return df.withColumn("sector", F.coalesce(F.col("sector"), F.lit(value)))


DEDUP_KEYS = ("symbol", "event_time", "open", "high", "low", "close", "volume")


def dedup_ticks(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Drop re-sent copies of a bar (same symbol, time and OHLCV), keeping
    the first ``seq``.  A hash aggregate with map-side combine; optional,
    the enrichment does not apply it by default."""
    other = [c for c in df.columns if c not in keys and c != "seq"]
    o = F.struct(F.col("seq"), *[F.col(c) for c in other])
    return (df.groupBy(*keys).agg(F.min(o).alias("_first"))
              .select(*keys, "_first.*"))
