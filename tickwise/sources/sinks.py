"""Writers: raw archive, enriched table, metrics and state snapshots.

Batch writers are idempotent per ``batch_id``: each streaming batch
lands in its own ``batch_id=N`` partition written with dynamic
partition overwrite, so a re-run of a failed batch replaces its files
instead of duplicating them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickwise.operators.snapshot import tail_per_symbol
from tickwise.schema import ENRICHED_TICK, RAW_TICK, conform
from tickwise.sources.layout import planned


JSON_OPTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
             "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _write(df: DataFrame, path: str, parts: list[str], batch_id: int | None, mode: str,
           rebalance: bool, order: list[str] = ()):
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        parts = ["batch_id"] + parts
        mode = "overwrite"
    if rebalance and batch_id is not None:
        # adaptive execution is off inside foreachBatch: write tasks are planned from counts
        df, _ = planned(df, tuple(parts))
    elif rebalance:
        # AQE rebalance: ~advisory-size files per partition value, hot values split
        df = df.hint("rebalance", *parts)
    if order:
        df = df.sortWithinPartitions(*parts, *order)
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*parts).parquet(path))


def write_raw(df: DataFrame, path: str, batch_id: int | None = None, mode: str = "append",
              rebalance: bool = True):
    """Raw archive, partitioned by date."""
    _write(conform(df, RAW_TICK), path, ["date"], batch_id, mode, rebalance)


def write_enriched(df: DataFrame, path: str, batch_id: int | None = None, mode: str = "append",
                   rebalance: bool = True, partition_cols=("date",)):
    """Enriched table, partitioned by date (declared schema).

    A folder per symbol and day would be millions of tiny files; rows are
    sorted by symbol inside the files of a day instead, so that a symbol
    filter skips row groups.  ``partition_cols`` restores other layouts.
    """
    _write(conform(df, ENRICHED_TICK), path, list(partition_cols), batch_id, mode, rebalance,
           order=[c for c in ("symbol", "event_time", "seq") if c not in partition_cols])


def write_jsonl(df: DataFrame, path: str, mode: str = "append"):
    w = df.write.mode(mode)
    for k, v in JSON_OPTS.items():
        w = w.option(k, v)
    w.json(path)


def state_snapshot(df: DataFrame, n: int = 50) -> DataFrame:
    """The last ``n`` enriched rows per symbol (the warm-start history)."""
    return conform(tail_per_symbol(df, n).drop("pos_from_end"), ENRICHED_TICK)


def write_state_snapshot(df: DataFrame, path: str, n: int = 50):
    write_jsonl(state_snapshot(df, n), path, mode="overwrite")


def compact(spark, src: str, dst: str, schema=ENRICHED_TICK, partition_cols=("date",),
            order=("symbol", "event_time", "seq")):
    """Rewrite a table made of many small per-batch files (``batch_id=N``
    folders from the streaming sink) into one file set per partition value.

    AQE ``rebalance`` on the partition columns sizes the write tasks (hot
    values are split across tasks, tiny ones merged); rows are sorted within
    files so symbol/time predicates skip row groups.  Writes to ``dst``
    (then swap paths), never in place.
    """
    df = spark.read.schema(schema).parquet(src)
    if "batch_id" in df.columns:
        df = df.drop("batch_id")
    (df.hint("rebalance", *partition_cols)
       .sortWithinPartitions(*partition_cols, *[c for c in order if c not in partition_cols])
       .write.mode("overwrite").partitionBy(*partition_cols).parquet(dst))
