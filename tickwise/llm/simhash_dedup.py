"""Near-duplicate documents by SimHash and covering locality-sensitive hashing.

Bit ``i`` of a fingerprint gets a non-zero vector of ``radius + 1`` bits; for
each non-zero vector ``v`` a mask keeps the bits whose vector has an odd inner
product with ``v``.  Up to ``radius`` differing bits span fewer than
``radius + 1`` dimensions, so some mask keeps none of them: every pair within
the radius agrees in some table, without exception.

Work is on distinct fingerprints.  A bucket of up to ``BUCKET`` fingerprints is
compared pair by pair.  A larger one is linked exactly without pairs: members
agree on the mask, so each is sent to itself and to its one-bit changes outside
the mask; two meet at a point iff they differ in at most two bits, a point has
at most 65 members, and they are chained to the smallest.  Components are then
found by star contraction.

Null and empty texts have fingerprint zero and link like any other; equal rows
share a component; a null id never names a component that has other ids, and a
component with null ids only has a null name.  Only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches
from .components import components

BITS = 64
RADIUS = 2
BUCKET = 64
BLOCK = 1 << 16
SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats counted."""
    import xxhash

    words = (text or "").encode().lower().split()   # both ASCII only on bytes
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle)), strict=False) if len(part) >= shingle else [part]
        h = np.fromiter((digest(b" ".join(g), SEED) for g in grams), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little", signed=False) - (int(bits[-1] >= 128) << 64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], pa.int64())],
                names=["id", "fp"])
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), make, f"id {kind}, fp long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The structured masks, as signed 64-bit numbers."""
    span = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, span + 1):
        m = sum(1 << i for i in range(bits) if ((i % span + 1) & v).bit_count() % 2)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def _signed(i: int) -> int:
    return (1 << i) - ((1 << 64) if i == 63 else 0)


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints ``fp`` that connect exactly
    those within ``radius`` bits (1 or 2)."""
    if radius not in (1, 2):
        raise ValueError("radius 1 or 2")
    masks = covering_masks(radius)
    members = fps.select("fp", F.explode(F.array(*(
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for t, m in enumerate(masks)))).alias("b")).select("fp", "b.t", "b.key")
    sizes = members.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(members.join(sizes, ["t", "key"]), "simhash-shared")
    small = shared.where(F.col("n") <= BUCKET)
    a = small.select("t", "key", F.col("fp").alias("u"))
    b = small.select("t", "key", F.col("fp").alias("v"))
    pairs = a.join(b, ["t", "key"]).where(
        (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v")
    free = [[_signed(i) for i in range(BITS) if not m >> i & 1] for m in masks]
    flips = F.element_at(F.array(*(F.array(*(F.lit(x) for x in f)) for f in free)), F.col("t") + 1)
    # within 1 bit: meet at one of the two; within 2 bits: meet at the change between
    points = shared.where(F.col("n") > BUCKET).select("fp", F.explode(F.concat(
        F.array("fp"), F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x)))).alias("point"))
    if radius == 1:
        points = points.join(fps.select(F.col("fp").alias("point")), "point", "left_semi")
    stars = points.groupBy("point").agg(F.collect_set("fp").alias("at")).where(F.size("at") > 1) \
        .select(F.array_min("at").alias("u"), F.explode("at").alias("v")).where("u <> v")
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = RADIUS) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits), ``component_id``
    (the smallest id reachable over links of at most ``radius`` bits)."""
    named, classes = _grouped(docs, id_col, text_col, shingle, radius)
    return named.join(classes.drop("root"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    named = cut(fingerprints(docs, id_col, text_col, shingle), "simhash")
    fps = cut(named.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    comp = components(links(fps, radius)).withColumnsRenamed({"node": "fp"})
    rooted = fps.join(comp, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return named, rooted.join(names, "root").select("fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             radius: int = RADIUS) -> DataFrame:
    """The input rows with one row of each component: that of its smallest id.
    Several rows with that id leave one of them; a component in which no row has
    an id leaves the one with the smallest hash of all its columns."""
    named, classes = _grouped(docs, id_col, text_col, shingle, radius)
    kept = named.join(classes, "fp").where("id = component_id").groupBy("id").agg(F.count("*").alias("_n"))
    kept = cut(kept, "simhash-kept").withColumnRenamed("id", "_id")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    # the kept ids grow with the rows: the join is by shuffle at every size
    found = rows.join(kept.hint("merge"), F.col("row")[id_col] == F.col("_id"))
    once = found.where("_n = 1").select("row.*")
    repeated = found.where("_n > 1").select("row.*").dropDuplicates([id_col])
    nobody = rows.where(F.col("row")[id_col].isNull()).withColumn("_hash", F.xxhash64("row"))
    unnamed = fingerprints(nobody.select(F.col("_hash").alias("id"), F.col("row")[text_col].alias("text")), "id", "text", shingle)
    left = (unnamed.join(classes.where("component_id IS NULL"), "fp").groupBy("root").agg(F.min("id").alias("_hash"))
            .select("_hash"))
    nobody = nobody.join(left, "_hash").dropDuplicates(["_hash"]).select("row.*")
    return once.unionByName(repeated).unionByName(nobody)
