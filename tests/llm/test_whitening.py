import math
from fractions import Fraction

import numpy as np
import pytest

from tickwise.llm import whitening as M
from tickwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<float>, n string, x string, deviation string"


def brute(rows, components=8, distinct=False):
    """Per (id, component): plain whitening of the whole list of vectors."""
    kept = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for d in {len(x) for _, x in kept}:
        fit = [x for _, x in kept if len(x) == d]
        fit = [list(t) for t in {tuple(x) for x in fit}] if distinct else fit
        n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]

        def centred(x):
            return [float(Fraction(a) - Fraction(b, n)) for a, b in zip(x, s, strict=True)]

        v = np.cov(np.array([centred(x) for x in fit]), rowvar=False, bias=True).reshape(d, d)
        e, u = np.linalg.eigh(v)
        for i, x in ((i, x) for i, x in kept if len(x) == d):
            for k in range(min(components, d)):
                if e[d - 1 - k] > d * 2.3e-16 * e[-1]:
                    out.append((i, k + 1, n, sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)),
                                np.array(centred(x)) @ u[:, d - 1 - k] / math.sqrt(e[d - 1 - k]), e[d - 1 - k] / np.trace(v)))
    return out


def same(got, want):
    got = sorted((tuple(r) for r in got), key=lambda r: (str(r[0]), r[1], r[3], abs(r[4])))
    want = sorted(want, key=lambda r: (str(r[0]), r[1], r[3], abs(r[4])))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    signs = {}
    for g, w in zip(got, want, strict=True):
        assert abs(g[4]) == pytest.approx(abs(w[4]), abs=1e-7) and g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] <= 1e-8
        if abs(w[4]) > 1e-6:     # either sign, the same for all rows
            signs.setdefault((len(want), g[1]), set()).add(np.sign(g[4] * w[4]))
    return signs


def test_query_equals_plain_whitening(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op12_embedding_whitening"](spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert all(len(s) == 1 for s in same(got.collect(), brute(rows)).values())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], KIND)


def odd_rows():
    rnd = np.random.default_rng(3)
    vectors = rnd.normal(0, 0.3, (40, 4)).astype(np.float32).tolist()
    return [*enumerate(vectors), *[(100 + i, vectors[0]) for i in range(60)], (7, vectors[1]), (None, vectors[2]),
            (None, vectors[2]), (200, None), (201, [1.0, None, 2.0, 3.0]), (202, [1.0, math.nan, 2.0, 3.0]),
            (203, [math.inf, 0.0, 0.0, 0.0]), (204, []), (205, [0.5, -0.5]), (206, [0.25, 1.5]), (207, [2.0, 1.5])]


@pytest.mark.parametrize("heavy", [1, 10, 1000])
def test_copies_nulls_lengths_and_clashing_names(spark, monkeypatch, heavy):
    monkeypatch.setattr(M, "HEAVY", heavy)
    same(M.whitened_components(frame(spark, odd_rows())).collect(), brute(odd_rows()))


def test_distinct_vectors_may_weigh_one(spark):
    rows = [r for r in odd_rows() if r[1] is None or len(r[1]) == 4]
    same(M.whitened_components(frame(spark, rows), weights="one").collect(), brute(rows, distinct=True))


def test_wide_numbers_stay_exact(spark):
    rows = [(1, [2.0 ** 40, 0.0]), (2, [-(2.0 ** 40), 1.0]), (3, [5.0, 3.0])]
    got = {r.vec_id: int(r.deviation) for r in M.whiten(frame(spark, rows)).collect()}
    assert got == {i: dev for i, k, _, dev, *_ in brute(rows) if k == 1}


def test_nothing_to_whiten(spark):
    none = frame(spark, [(1, None), (2, [math.nan])])
    assert M.whitened_components(none).count() == M.whitened_components(none.limit(0)).count() == 0
    assert M.whitened_components(frame(spark, [(1, [1.0, 2.0])] * 5)).count() == 0     # no spread, no component
    assert [r.whitened for r in M.whiten(frame(spark, [(1, [1.0, 2.0])] * 5)).collect()] == [[]] * 5
