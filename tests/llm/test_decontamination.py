import random

from tickwise.llm import decontamination as M
from .conftest import EDGE


def items_of(spark, name="sf0.01"):
    return spark.read.parquet(f"/root/testdata/{name}/benchmark.parquet")


def exhaustive(items, words, threshold):
    """Scores of all items for one passage, without index or bounds."""
    index = M.Index.build(items)
    scores = {}
    for t in {index.terms[w] for w in words if w in index.terms}:
        for posts in index.postings[t]:
            for item, x in posts:
                scores[item] = scores.get(item, 0) + x
    return {i: s for i, s in scores.items() if s >= threshold - 1e-6}


def test_wand_retrieves_all_above_threshold(spark):
    items = [tuple(r) for r in items_of(spark).collect()]
    index, rnd = M.Index.build(items), random.Random(3)
    pool = [w for _, t in items for w in M.words_of(t.lower())]
    for _ in range(60):
        i = rnd.randrange(len(items))
        words = M.words_of(items[i][1].lower())[: rnd.randrange(4, 60)] + rnd.sample(pool, 40)
        terms = sorted({index.terms[w] for w in words})
        for threshold in (0.2, 0.5):
            got = {}
            for b in range(index.bound.shape[1]):
                got |= dict(index.walk(terms, b, threshold))
            want = exhaustive(items, words, threshold)
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_planted_items_are_found_wherever_they_stand(spark):
    items, rnd = [tuple(r) for r in items_of(spark).collect()], random.Random(5)
    filler = [f"w{rnd.randrange(900)}" for _ in range(3000)]
    docs, want = [], set()
    for d, (i, t) in enumerate(items):
        at = rnd.randrange(len(filler))
        docs.append((d, " ".join(filler[:at]) + f"\n{t}\n" + " ".join(filler[at:])))
        want.add((d, i))
        words = t.split()
        rnd.shuffle(words)
        docs.append((1000 + d, " ".join(filler[:at] + words + filler[at:])))    # same words, other order
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in M.contaminated_pairs(df, items_of(spark)).collect()}
    assert got == want
    left = {r.doc_id for r in M.keep_clean(df, items_of(spark)).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}


def test_documents_against_all_shingles(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.item_id) for r in M.contaminated_pairs(docs, items_of(spark)).collect()}
    want = set()
    grams = {r.item_id: M.shingles(M.words_of(r.text.lower()), 5) for r in items_of(spark).collect()}
    for r in docs.collect():
        have = M.shingles(M.words_of(r.text.lower()), 5)
        want |= {(r.doc_id, i) for i, g in grams.items() if len(g & have) >= 0.8 * len(g)}
    assert got == want


def test_shards_and_blocks_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    def found():
        return sorted((*tuple(r)[:2], *(round(x, 9) for x in tuple(r)[2:]))
                      for r in M.contaminated_pairs(docs, items_of(spark, "sf0.001")).collect())
    want = found()
    clean = {r.doc_id for r in M.keep_clean(docs, items_of(spark, "sf0.001")).collect()}
    monkeypatch.setattr(M, "SHARD_ITEMS", 7)
    monkeypatch.setattr(M, "PASS_BYTES", 2000)
    assert want and found() == want     # scores and overlaps, too
    assert {r.doc_id for r in M.keep_clean(docs, items_of(spark, "sf0.001")).collect()} == clean
    text = "a b c " * 50 + "Alpha beta gamma delta epsilon zeta? Eta theta." + " d e f" * 50
    index = M.Index.build([(1, "Alpha beta gamma delta epsilon zeta? Eta theta.")])
    monkeypatch.setattr(M, "TEXT_BLOCK", 64)
    assert list(index.search(text)) == [0]


def test_look_alikes_in_other_shards_change_no_score(spark, monkeypatch):
    """Items that share most of their words: scores equal a plain BM25 over all of them."""
    rnd = random.Random(9)
    stem = [f"s{i}" for i in range(20)]
    items = [(i, " ".join([*stem, *(f"w{rnd.randrange(40)}" for _ in range(6))]) + f"? Answer a{i % 5}.") for i in range(120)]
    passage = " ".join(items[3][1].split()[:-3] + ["x", "Answer", "a3"])
    n, words = len(items), [M.words_of(t.lower()) for _, t in items]
    mean, df = sum(map(len, words)) / n, {}
    for w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1

    def impact(t, w):
        f = w.count(t)
        return (M.math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (M.K1 + 1)
                / (f + M.K1 * (1 - M.B + M.B * len(w) / mean)))
    have = set(M.words_of(passage.lower()))
    want = {i: sum(impact(t, w) for t in set(w) & have) / sum(impact(t, w) for t in set(w)) for (i, _), w in zip(items, words)}
    frame = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, passage)], "doc_id long, text string")
    seen = []
    for limit in (2048, 11):
        monkeypatch.setattr(M, "SHARD_ITEMS", limit)
        got = {r.item_id: r.score for r in M.contaminated_pairs(docs, frame).collect()}
        assert 3 in got and all(abs(got[i] - want[i]) < 1e-6 for i in got)
        seen.append(sorted(got))
    assert seen[0] == seen[1]


def test_edges(spark, edge, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "alpha beta gamma"), (3, "alpha beta gamma"), (None, "?!")],
                                  "item_id long, text string").selectExpr("*", "1 AS id", "2 AS size")
    got = sorted(tuple(r)[:2] for r in M.contaminated_pairs(edge, items).collect())
    assert got == [(1, 3)] * 4
    kept = sorted(((r.doc_id, r.text) for r in M.keep_clean(edge, items).collect()), key=str)
    assert kept == sorted(((i, t) for i, t, _, _ in EDGE if t != "alpha beta gamma"), key=str)
    assert M.contaminated_pairs(empty, items).count() == 0
    assert M.contaminated_pairs(edge, items.limit(0)).count() == 0
    assert M.keep_clean(edge, items.limit(0)).count() == len(EDGE)
