import numpy as np

from tickwise.llm import language_id as M
from .conftest import EDGE


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, p = M.train(docs.where(~M.held_out()))
    assert langs == ["de", "en", "es", "fr"] and np.allclose(p.sum(axis=1), 1, atol=1e-3)
    rows = M.predict(docs.where(M.held_out()), langs, p, extra=("lang",)).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixture_finds_both_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 3000")
    langs, p = M.train(docs)
    by = {r.lang: r.text for r in docs.where("lang IN ('de', 'es')").collect()}
    n = min(map(len, by.values()))
    chosen, theta = M.infer(p, M.gram_counts(by["de"][:n] + " " + by["es"][: n // 2]))
    assert [langs[i] for i in chosen] == ["de", "es"] and 0.5 < theta[langs.index("de")] < 0.8


def test_em_never_loses_likelihood():
    rnd = np.random.default_rng(1)
    p = rnd.dirichlet(np.ones(50), 3)
    c = rnd.integers(1, 9, 50).astype(float)
    last = -np.inf
    for rounds in range(1, 12):
        M.ROUNDS, keep = rounds, M.ROUNDS
        _, fit = M.mixture(p, c)
        M.ROUNDS = keep
        assert fit >= last - 1e-9
        last = fit


def test_edges(spark, edge, empty):
    langs, p = M.train(edge)
    got = {(r.doc_id, r.n_tokens): (r.lang_pred, r.score) for r in M.predict(edge, langs, p, extra=("n_tokens",)).collect()}
    assert got[2, None] == got[3, "x"] == got[4, "x"] == ("und", 0.0)
    assert got[6, "z"][0] == "de" and got[1, "n"][0] == "en"
    none, q = M.train(empty)
    assert none == [] and {r.lang_pred for r in M.predict(edge, none, q).collect()} == {"und"}
    assert M.predict(empty, langs, p).count() == 0


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = "Ein langer Text, Überall. " * 400
    whole = M.gram_counts(text)
    monkeypatch.setattr(M, "BLOCK", 1000)
    parts = M.gram_counts(text)
    # a block edge may only add a space at its start
    assert abs(int(whole.sum()) - int(parts.sum())) <= 2 * (len(text) // 1000)
    assert len(EDGE) and (np.minimum(whole, parts).sum() / whole.sum()) > 0.98
