import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickwise.llm import toxicity as M
from tickwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())


def brute(rows, least=M.LEAST, d=M.DISCOUNT):
    """Plain class-conditional Kneser-Ney over (toxic, text): text -> list of log ratios."""
    counts = {1: Counter(), 0: Counter()}
    for y, t in rows:
        counts[y].update(set(words(t)))
    n = {y: sum(c.values()) for y, c in counts.items()}
    share = n[1] / (n[0] + n[1])

    def frequent(t, o):
        return t >= max(least, M.RARE * n[1]) or t + o >= max(least / share, M.RARE * (n[0] + n[1]))

    known = {w for w in {*counts[0], *counts[1]} if frequent(counts[1][w], counts[0][w])}

    def mapped(t):
        return ["<s>"] + [w if w in known else "?" for w in words(t)]

    pairs = {1: Counter(), 0: Counter()}
    for y, t in rows:
        m = mapped(t)
        pairs[y].update(set(zip(m, m[1:])))
    vocabulary = {*known, "?", "<s>"}
    shared = {w: 0.5 + sum(b == w for _, b in {*pairs[0], *pairs[1]}) for w in vocabulary}
    kept = {p for p in {*pairs[0], *pairs[1]} if frequent(pairs[1][p], pairs[0][p])}
    models = {}
    for y in (0, 1):
        places = Counter(b for _, b in pairs[y])
        own = {w: max(places[w] - d, 0) for w in vocabulary}
        left = sum(places.values()) - sum(own.values())
        word = {w: (own[w] + left * shared[w] / sum(shared.values())) / sum(places.values()) for w in vocabulary}
        total, off = Counter(), defaultdict(float)
        for (a, b), c in pairs[y].items():
            total[a] += c
            off[a] += c - d if (a, b) in kept else 0

        def p(a, b, y=y, word=word, total=total, off=off):
            if not total[a]:
                return word[b]
            direct = max(pairs[y][a, b] - d, 0) if (a, b) in kept else 0
            return (direct + (total[a] - off[a]) * word[b]) / total[a]
        models[y] = p
    return lambda t: [math.log(models[1](a, b) / models[0](a, b)) for a, b in {*zip(mapped(t), mapped(t)[1:])}]


def labelled_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    return docs, labels, [(r.toxic, r.text) for r in docs.join(labels, "doc_id").collect()]


def test_ratios_equal_plain_kneser_ney(spark):
    docs, labels, rows = labelled_rows(spark)
    model, plain = M.train(docs, labels), brute(rows)
    for r in M.score(docs, model, extra=("text",)).collect():
        want = plain(r.text)
        assert r.ratio == pytest.approx(np.mean(want) if want else 0.0, abs=1e-9)
        n = max(len(want), 1)
        x = np.array([[sum(want) / n, min(0.05, sum(max(v - 3, 0) for v in want) / n)]])
        assert r.score == pytest.approx(float(model.scores(x)[0]), abs=1e-7) and r.predicted == (r.score >= 0.7)


def test_held_out_accuracy(spark):
    got = QUERIES["op11_toxicity"](spark, "/root/testdata/sf0.1")
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "ratio"]
    assert dict(got.dtypes)["score"] == "double" and dict(got.dtypes)["predicted"] == "int"
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert len(toxic) > 100 and sum(r.predicted for r in toxic) / len(toxic) > 0.9
    assert sum(r.predicted for r in clean) / len(clean) < 0.01


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", M.F.when(M.held_out(), 1 - M.F.col("toxic")).otherwise(M.F.col("toxic")))
    a, b = (M.train(docs.where(~M.held_out()), x) for x in (labels, flipped))
    assert np.array_equal(a.curve, b.curve) and np.array_equal(a.of_pair, b.of_pair)


def test_odd_rows(spark, edge, empty):
    marks = [(1, 1, "a"), (5, 0, "b"), (6, 0, "c"), (6, 0, "c"), (3, 2, "d"), (4, None, "e"), (2, 1, "f"), (2, 0, "g"), (None, 1, "h")]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, text string")
    model = M.train(edge, labels)
    rows = M.score(edge, model, extra=("lang", "kept", "text")).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    nothing = {r.score for r in rows if r.doc_id in (2, 3, 4)}
    assert len(nothing) == 1 and {r.ratio for r in rows if r.doc_id in (2, 3, 4)} == {0.0}
    assert len({(r.text, r.score) for r in rows}) == len({r.text for r in rows})      # copies score alike
    # nothing to learn from, in one class or in both
    for learned in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        constant = M.score(edge, M.train(edge, learned)).collect()
        assert len(constant) == edge.count() and len({r.score for r in constant}) == 1
    assert M.score(empty, model).count() == 0 and M.train(empty, labels).curve is None


def test_blocks_and_groups_change_nothing(spark, monkeypatch):
    docs, labels, _ = labelled_rows(spark)
    model = M.train(docs, labels)
    want = {r.doc_id: r.score for r in M.score(docs, model).collect()}
    text = "Ein Satz, über zwei Zeilen\nund mehr. " * 40
    whole = M.Hashes().of(text)
    monkeypatch.setattr(M, "BLOCK", 7)
    assert np.array_equal(M.Hashes().of(text), whole) and len(M.Hashes().of(None)) == 0
    got = {r.doc_id: r.score for r in M.score(docs.repartition(5), model).collect()}
    assert got == want


def test_pairs_below_the_share_are_joined(spark, monkeypatch):
    docs, labels, rows = labelled_rows(spark)
    want = {r.doc_id: r for r in M.score(docs, M.train(docs, labels)).collect()}
    plain = brute(rows)
    monkeypatch.setattr(M, "RARE", 1e-3)      # most pairs are no longer broadcast
    model = M.train(docs, labels)
    assert model.more.count() > len(model.pair_keys) > 0
    got = M.score(docs, model, extra=("text",)).collect()
    assert len(got) == len(want)
    for r in got:
        x = plain(r.text)
        assert r.ratio == pytest.approx(np.mean(x) if x else 0.0, abs=1e-9)
        assert r.score == pytest.approx(want[r.doc_id].score, abs=1e-6) and r.predicted == want[r.doc_id].predicted


def test_no_pair_broadcast_and_a_full_bit_map(spark, edge, monkeypatch):
    marks = spark.createDataFrame([(1, 1), (5, 0), (6, 0)], "doc_id long, toxic int")

    def scores():
        rows = M.score(edge, M.train(edge, marks), extra=("lang", "text")).collect()
        return sorted((str(r.text), str(r.doc_id), r.score) for r in rows)

    want = scores()
    monkeypatch.setattr(M, "LEAST", 1)
    low = scores()
    monkeypatch.setattr(M, "RARE", 2.0)
    monkeypatch.setattr(M, "MARKS", 6)
    got = scores()
    assert [r[:2] for r in got] == [r[:2] for r in low] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in low], abs=1e-6)
