"""Files of a write planned from row counts, where adaptive execution doesn't size them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ROWS_PER_FILE = 1_000_000


def planned(df: DataFrame, parts: tuple[str, ...], rows_per_file: int = ROWS_PER_FILE) -> tuple[DataFrame, int]:
    """``df`` dealt out so that each write task holds one file of one partition value; its rows."""
    if not parts:
        n = df.count()
        return df.repartition(max(1, -(-n // rows_per_file))), n
    counts = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n")).orderBy(*parts).collect()    # one row a value
    plan, at = [], 0
    for r in counts:
        files = -(-r["_n"] // rows_per_file)
        plan.append((*[r[p] for p in parts], at, files))
        at += files
    if not plan:
        return df, 0
    kinds = ", ".join(f"`{p}` {df.schema[p].dataType.simpleString()}" for p in parts)
    sizes = df.sparkSession.createDataFrame(plan, f"{kinds}, _at int, _files int")
    same = [df[p].eqNullSafe(sizes[p]) for p in parts]
    on = same[0]
    for c in same[1:]:
        on = on & c
    dealt = df.join(F.broadcast(sizes), on).drop(*[sizes[p] for p in parts])
    spread = F.col("_at") + F.pmod(F.xxhash64(*[c for c in df.columns if c not in parts]), F.col("_files")).cast("int")
    return (dealt.withColumn("_at", spread).repartitionById(at, F.col("_at")).drop("_at", "_files"),
            sum(r["_n"] for r in counts))
