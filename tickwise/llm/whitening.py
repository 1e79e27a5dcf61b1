"""Whitening of embeddings over distinct vectors.

A vector's entries c become integers x = floor(1024*c) + 100000.  Equal
x-vectors are grouped into one row with their count, which is its weight in the
fit (``weights="one"``: every distinct vector weighs 1).  Each task adds up a
weighted product of its centred vectors, a matrix of the dimension's size; the
driver adds nothing but these sums, takes the eigenvectors, and every distinct
vector is whitened once.  The rows get the result by a join on x.

Sums, means' numerators and deviations are exact integers; the centre S/n is
subtracted in two parts, whole and fraction, so that no digits are lost.
A vector that makes up more than 1/``HEAVY`` of all rows is joined by broadcast
(fewer than ``HEAVY`` such vectors can exist, at any size), the others by
shuffle, where a key then has few rows.

Rows whose vector is null or holds null or non-finite entries are left out.
Vectors of different lengths are spaces of their own, fitted apart; an empty
vector has no component.  Null and repeated ids are kept, one result per row.
Components whose eigenvalue is zero to double precision (repeated vectors only,
dependent dimensions) can't be scaled to one and are left out.  An entry whose x
isn't a 64-bit integer, or a deviation over 38 digits, is an error.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import cut

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
HEAVY = 1000


def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the rows whose vector is whole and finite."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull()).where(~bad)
            .select("id", F.transform("v", lambda c: F.when(
                F.abs(c) < 2.0 ** 52, F.floor(c * SCALE) + SHIFT).when(
                F.abs(c) < float("inf"),
                F.raise_error(F.lit("an entry is too large for a 64-bit x")).cast("long"))).alias("x")))


def _blocks(batch: pa.RecordBatch):
    """(rows of the batch, their vectors as one matrix) for every vector length."""
    v = batch.column("v")
    sizes = np.asarray(v.value_lengths())
    starts, flat = np.asarray(v.offsets)[:-1], np.asarray(v.values)
    for d in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == d)
        yield int(d), at, flat[starts[at][:, None] + np.arange(d)]


def _exact(a: np.ndarray, largest: int) -> np.ndarray:
    """``a`` as 64-bit integers if results up to ``largest`` fit, else as Python integers."""
    return a.astype(np.int64) if largest < 1 << 62 else a.astype(object)


def _sums(vectors: DataFrame) -> DataFrame:
    """(d, dim, s, w): exact weighted sums and the total weight of every length."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        weight: dict[int, int] = {}
        for b in batches:
            w = np.asarray(b.column("w"))
            for d, at, x in _blocks(b):
                top = int(np.abs(x).max()) * int(w[at].sum())
                s = (_exact(x, top) * _exact(w[at], top)[:, None]).sum(axis=0).astype(object)
                total[d] = total.get(d, 0) + s
                weight[d] = weight.get(d, 0) + int(w[at].sum())
        for d, s in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
                 pa.array([decimal.Decimal(int(t)) for t in s], pa.decimal128(38, 0)),
                 pa.array([weight[d]] * d, pa.int64())], names=["d", "dim", "s", "w"])

    return (vectors.mapInArrow(run, "d int, dim int, s decimal(38,0), w long")
            .groupBy("d", "dim").agg(F.sum("s").alias("s"), F.sum("w").alias("w")))


def _scatter(vectors: DataFrame, centres: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, np.ndarray]:
    """Weighted centred products, one symmetric matrix for each length."""
    model = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            w = np.asarray(b.column("w"), dtype=np.float64)
            for d, at, x in _blocks(b):
                whole, part = model.value[d]
                c = (x - whole).astype(np.float64) - part
                total[d] = total.get(d, 0) + (c * w[at][:, None]).T @ c
        for d, m in total.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                 pa.array(j.astype(np.int32)), pa.array(m[i, j])], names=["d", "i", "j", "v"])

    got = (vectors.mapInArrow(run, "d int, i int, j int, v double")
           .groupBy("d", "i", "j").agg(F.sum("v").alias("v"))).toArrow()
    out = {d: np.zeros((d, d)) for d in centres}
    d, i, j, v = (np.asarray(got.column(k)) for k in range(4))
    for size, m in out.items():
        at = d == size
        m[i[at], j[at]] = m[j[at], i[at]] = v[at]
    return out


def _principal(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    e, u = np.linalg.eigh(cov)
    order = np.argsort(-e, kind="stable")[:components]
    order = order[e[order] > len(e) * np.finfo(float).eps * max(e.max(), 0.0)]
    return e[order], u[:, order]


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS, weights: str = "count") -> DataFrame:
    """One row per kept input row: id, n, deviation decimal(38,0), whitened and
    explained (arrays, one entry a component), identity_error."""
    if weights not in ("count", "one"):
        raise ValueError(f"weights: {weights!r}")
    spark = df.sparkSession
    ship_package(spark)
    rows = integer_vectors(df, id_col, vec_col)
    distinct = cut(rows.groupBy("x").agg(F.count("*").alias("times")), "vectors")
    w = F.col("times") if weights == "count" else F.lit(1).cast("long")
    fit = distinct.select(F.col("x").alias("v"), w.alias("w"))

    sums = _sums(fit).collect()     # one row a dimension
    n = {r.d: int(r.w) for r in sums}
    s = {d: np.array([int(r.s) for r in sorted(sums, key=lambda r: r.dim) if r.d == d], object) for d in n}
    whole = {d: np.array([t // n[d] for t in s[d]], np.int64) for d in n}
    part = {d: np.array([(t - n[d] * int(m)) / n[d] for t, m in zip(s[d], whole[d], strict=True)]) for d in n}
    cov = {d: m / n[d] for d, m in _scatter(fit, {d: (whole[d], part[d]) for d in n}).items()}
    axes = {}
    for d, v in cov.items():
        e, u = _principal(v, components)
        axes[d] = (u / np.sqrt(e), (e / max(np.trace(v), np.finfo(float).tiny)).tolist())
    model = spark.sparkContext.broadcast((n, s, whole, part, {d: a for d, (a, _) in axes.items()}))

    def run(batches):
        n, s, whole, part, axes = model.value
        for b in batches:
            dev, y = [decimal.Decimal(0)] * b.num_rows, [[]] * b.num_rows
            for d, at, x in _blocks(b):
                c = ((x - whole[d]).astype(np.float64) - part[d]) @ axes[d]
                far = int(np.abs(x).max()) * n[d] + max(map(abs, s[d]))
                gap = _exact(x, far) * n[d] - _exact(s[d], far)
                gap = _exact(gap, d * int(np.abs(gap).max()) ** 2)
                for k, row, total in zip(at, c.tolist(), (gap * gap).sum(axis=1), strict=True):
                    y[k], dev[k] = row, decimal.Decimal(int(total))
            yield pa.RecordBatch.from_arrays(
                [b.column("v"), b.column("w"), pa.array(dev, pa.decimal128(38, 0)),
                 pa.array(y, pa.list_(pa.float64()))], names=["x", "w", "deviation", "y"])

    kind = "x array<long>, w long, deviation decimal(38,0), y array<double>"
    times = distinct.select(F.col("x").alias("v"), F.col("times").alias("w"))
    done = cut(times.mapInArrow(run, kind), "whitened")

    errors = {d: _identity_error(done, d, n[d], a.shape[1], weights) for d, (a, _) in axes.items()}
    facts = spark.createDataFrame(
        [(d, n[d], axes[d][1], errors[d]) for d in n],
        "d int, n long, explained array<double>, identity_error double")
    total = sum(r.c for r in [distinct.agg(F.sum("times").alias("c")).first()] if r.c)
    heavy = F.broadcast(done.where(F.col("w") * HEAVY > F.lit(total)))
    light = done.where(F.col("w") * HEAVY <= F.lit(total))
    joined = rows.join(heavy, "x").unionByName(rows.join(heavy.select("x"), "x", "left_anti").join(light, "x"))
    return (joined.withColumn("d", F.size("x")).join(F.broadcast(facts), "d")
            .select(F.col("id").alias(id_col), "n", "deviation", F.col("y").alias("whitened"),
                    "explained", "identity_error"))


def _identity_error(done: DataFrame, d: int, n: int, k: int, weights: str) -> float:
    """Largest entry of the covariance of the whitened vectors minus the identity."""
    if not k:
        return 0.0
    w = F.col("w") if weights == "count" else F.lit(1).cast("long")
    fit = done.where(F.size("x") == d).select(F.col("y").alias("v"), w.alias("w"))
    mean = fit.agg(*[F.sum(F.col("w") * F.col("v")[i]) for i in range(k)]).first()
    cov = _scatter(fit, {k: (np.zeros(k), np.array([m / n for m in mean]))})[k] / n
    return float(np.abs(cov - np.eye(k)).max())


def whitened_components(df: DataFrame, **options) -> DataFrame:
    """One row per kept row and component: the form of the registered query."""
    got = whiten(df, **options)
    at = F.posexplode("whitened").alias("pos", "value")
    return (got.select("vec_id", "n", "deviation", "explained", "identity_error", at)
            .select("vec_id", (F.col("pos") + 1).cast("int").alias("component"), "n",
                    F.col("deviation").cast("long").alias("deviation"), F.col("value").alias("whitened"),
                    F.col("explained")[F.col("pos")].alias("explained"), "identity_error"))
