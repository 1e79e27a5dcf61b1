import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tickwise.llm import collocations as M

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=2000, covered=80):
    counts = defaultdict(Counter)
    for lang, text in rows:
        f = counts["und" if lang is None else lang]
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        swallowed = {g[i:i + m] for g, b in candidates.items() for m in range(2, len(g))
                     for i in range(len(g) - m + 1) if 100 * b >= covered * f[g[i:i + m]]}
        found = []
        for g, a in candidates.items():
            if g not in swallowed:
                s, _, l, r = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                found.append((-s, -a, " ".join(g).encode(), l, r))
        n = sum(c for g, c in f.items() if len(g) == 1)
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, l, "x", "y", "z") for i, (l, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, word string, f string, n string")
    return sorted(tuple(r) for r in M.collocations(df.repartition(3), **options).collect())


def made_rows(seed=5, words=12, docs=60):
    rnd = np.random.default_rng(seed)
    vocabulary = [f"W{i}" if i % 3 else f"é{i}\x01" for i in range(words)]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", ", ", ";", "\x0b", "!?"]
    rows = []
    for _ in range(docs):
        n = int(rnd.integers(0, 80))
        text = "".join(vocabulary[int(rnd.zipf(1.6)) % words] + ends[rnd.integers(len(ends))] for _ in range(n))
        rows.append((["en", "de", None, "und"][rnd.integers(4)], text))
    return rows + [(None, None), ("en", None), ("en", ""), ("xx", "a a a a a a"), ("xx", "a a a a a a"), ("xx", "a\x01 b a b")]


@pytest.mark.parametrize("shard", [1, 50, 1 << 21])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(M, "SHARD_WORDS", shard)
    rows = made_rows()
    assert run(spark, rows, least=2) == brute(rows, least=2)
    assert run(spark, rows, least=3, top=4, covered=50) == brute(rows, least=3, top=4, covered=50)


def test_given_table_equals_brute_force_and_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in M.collocations(docs).collect())
    assert got and got == brute(rows)
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    assert sorted(con.execute(M.collocations_sql()).fetchall()) == got


def test_sql_on_odd_rows():
    rows = made_rows(8)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(M.collocations_sql(2, 50, 60)).fetchall()) == brute(rows, 2, 50, 60)


def test_nothing_to_count(spark, edge, empty):
    assert M.collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert M.collocations(empty).count() == M.collocations(empty, least=1).count() == 0
    assert run(spark, [("en", None), (None, " .,"), ("de", "one")], least=1) == []
    # repeated rows and a very long text; 30,000 equal words are phrases of themselves
    got = {(r.lang, r.phrase, r.a) for r in M.collocations(edge).collect()}
    assert got == {("de", "wort wort wort wort", 29_997)}


def test_texts_are_cut_at_piece_ends(monkeypatch):
    text = "a b c. d e f, g h i j k l\nm n ".encode()
    whole = M.words_of(text)
    monkeypatch.setattr(M, "BLOCK", 4)
    parts = [M.words_of(p) for p in M.blocks(text)]
    assert len(parts) > 2 and b"".join(M.blocks(text)) == text
    assert [w for p in parts for w in p if w != b"."] == [w for w in whole if w != b"."]
    assert list(M.blocks(b"")) == []


def test_index_extends_both_ways():
    rnd = np.random.default_rng(2)
    t = np.append(rnd.integers(0, 6, 400), 0)
    want = [Counter(tuple(int(x) for x in t[i:i + k]) for i in range(len(t) - k + 1) if 0 not in t[i:i + k]) for k in (2, 3, 4)]
    forward, reverse = M.Index.of(t), M.Index.of(t[::-1])
    a, b, lo, rlo, n = M._pairs(forward, reverse)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == want[0]
    p, c, rlo3, lo3, n3 = reverse.extend(rlo, lo, n)
    assert dict(zip(zip(a[p].tolist(), b[p].tolist(), c.tolist()), n3.tolist())) == want[1]
    q, d, lo3l, rlo3l, m3 = forward.extend(lo, rlo, n)
    assert dict(zip(zip(d.tolist(), a[q].tolist(), b[q].tolist()), m3.tolist())) == want[1]
    s, d, *_, m = forward.extend(lo3, rlo3, n3)
    assert dict(zip(zip(d.tolist(), a[p][s].tolist(), b[p][s].tolist(), c[s].tolist()), m.tolist())) == want[2]
    s, e, *_, m = reverse.extend(rlo3l, lo3l, m3)
    assert dict(zip(zip(d2 := forward.extend(lo, rlo, n)[1][s].tolist(), a[q][s].tolist(), b[q][s].tolist(), e.tolist()), m.tolist())) == want[2] and d2


def test_pairs_travel_as_arrays_in_buckets(spark, monkeypatch):
    a = np.array([0, 5, 1 << 40, (1 << 33) + 7])
    assert np.array_equal(M.unpack_long(M.pack_long(a)), a) and len(M.unpack_long(M.pack_long(a[:0]))) == 0
    monkeypatch.setattr(M, "SHARD_WORDS", 50)
    monkeypatch.setattr(M, "BUCKET", 100)
    rows = made_rows()
    assert run(spark, rows, least=2) == brute(rows, least=2)
    # (shard, first word, second word, count): a row a shard and bucket, summed over shards, told once
    counts = [(7, [1, 1, 9], [2, 3, 9], [2, 1, 1]), (3, [1, 9], [2, 9], [1, 1])]
    made = [(s, at, *M.packed_row(g, n)) for s, *x in counts
            for at, g, n in M.bucketed([np.array(x[0]), np.array(x[1])], np.array(x[2]), 2)]
    table = spark.createDataFrame(made, "shard long, bucket long, g1 binary, g2 binary, n binary")
    got = set()
    for r in M.frequent_pairs(table, 2).collect():
        g1, g2, f = (M.unpack_long(bytes(x)).tolist() for x in (r.g1, r.g2, r.f))
        got |= {(r.shard, p, q, n) for p, q, n in zip(np.cumsum(g1).tolist(), g2, f)}
    assert got == {(3, 1, 2, 3), (7, 1, 2, 0), (3, 9, 9, 2), (7, 9, 9, 0)}


def test_words_travel_as_arrays_in_buckets(spark, monkeypatch):
    words = [b"a", "é\x01".encode(), b"w" * 300]
    assert M.unpack_words(M.pack_words(words)).to_pylist() == [w + b" " for w in words]
    assert M.unpack_words(M.pack_words([])).to_pylist() == []
    assert M.coded(["de", "en", "xx"], np.array([2, 0, 2]))[0] == ["de", "xx"]
    monkeypatch.setattr(M, "SHARD_WORDS", 50)
    rows = made_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    shards = M.cut(M.shards(docs, "lang", "text"), "shards")
    held, want, names = {}, Counter(), {}
    for r in shards.collect():
        t = M.unpack(bytes(r.ids))
        words = [w[:-1].decode() for w in M.unpack_words(bytes(r.words)).to_pylist()]
        lang = [r.langs[i].lang for i in M.unpack(bytes(r.code))]
        held[r.shard] = {i: (lang[i - 1], words[i - 1]) for i in set(t.tolist()) - {0}}
        names[r.shard] = {x.lang for x in r.langs}
        for i, n in Counter(t[t > 0].tolist()).items():
            want[lang[i - 1], words[i - 1]] += n
        for x in r.langs:
            assert x.n == sum(lang[i - 1] == x.lang for i in t[t > 0])
    assert len(held) > 9
    assert want == Counter(("und" if k is None else k, w) for k, x in rows for p in re.split("[.,;:!?\n-\r]", (x or "").translate(LOWER))
                           for w in re.findall("[^ \t]+", p))
    counts = M.cut(M.word_counts(shards, 4), "counts")
    # one row a shard and bucket, whatever the number of words, with the languages of its own words
    assert counts.count() == counts.select("shard", "bucket").distinct().count() <= 4 * len(held)
    assert all(set(r.langs) <= names[r.shard] for r in counts.collect())
    known = M.cut(M.frequent_words(counts, 3, 4), "known")
    spelt = {r.id: r.word for r in M.spelt_words(known).collect()}
    assert len(spelt) == sum(n >= 3 for n in want.values()) and min(spelt) > 0
    got = Counter()
    for r in known.where("shard IS NOT NULL").collect():
        id_, f = np.cumsum(M.unpack_long(bytes(r.id))).tolist(), M.unpack_long(bytes(r.f)).tolist()
        assert f == sorted(f, reverse=True) and id_ == sorted(set(id_))
        for i, n, at, c in zip(id_, f, M.unpack(bytes(r.number)).tolist(), M.unpack(bytes(r.code)).tolist(), strict=True):
            assert held[r.shard][at] == (r.langs[c], spelt[i]) and n == want[r.langs[c], spelt[i]]
            got[r.shard] += 1
    assert got == Counter({s: k for s, own in held.items() if (k := sum(want[x] >= 3 for x in own.values()))})


def test_shuffled_words_take_few_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    shards = M.cut(M.shards(docs, "lang", "text"), "shards")
    words, size = 0, 0
    for r in M.word_counts(shards, 4).collect():
        words += len(M.unpack(bytes(r.number)))
        size += sum(len(bytes(r[c])) for c in ("code", "words", "number", "n"))
    assert words > 10_000 and size < 10 * words


def test_many_languages(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_WORDS", 50)
    rows = [(f"l {i % 90}", "a b c. a b c d") for i in range(300)] + made_rows(6, docs=20)
    assert run(spark, rows, least=2) == brute(rows, least=2)
