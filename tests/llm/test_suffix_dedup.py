import hashlib
import random
from collections import Counter

import pytest

from tickwise.llm import suffix_dedup as M
from .conftest import EDGE


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(d[k:k + 200] for d in texts for k in range(len(d) - 199))
    out = []
    for (i, _), d in zip(rows, texts, strict=True):
        gone = bytearray(len(d))
        for k in range(len(d) - 199):
            if times[d[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        kept = bytes(x for x, f in zip(d, gone, strict=True) if not f)
        runs = sum(1 for k in range(len(d)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    w = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    shared, rows = [w(rnd.randrange(150, 420)) for _ in range(8)], []
    for i in range(80):
        t = w(rnd.randrange(400))
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(shared)
            if rnd.random() < 0.4:
                a = rnd.randrange(len(p))
                p = p[a:] if rnd.random() < 0.5 else p[:a]
            if rnd.random() < 0.3:
                a = rnd.randrange(len(p) + 1)
                p = p[:a] + w(1) + p[a:]
            t += p + w(rnd.randrange(60))
        rows.append((i if rnd.random() < 0.95 else None, t))
    return rows + [(500, "ab" * 400), (501, "x" * 900), (501, "x" * 900), (502, None), (None, None), (503, ""),
                   (504, w(250) + "y" * 199), (505, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize("hot", [M.HOT, 3, 0])
def test_equals_brute_force(spark, hot):
    rows = corpus(11)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, M.remove_repeats(df, hot=hot).collect()), key=str) == brute(rows)


def test_edges(spark, edge, empty):
    got = sorted(map(tuple, M.remove_repeats(edge).collect()), key=str)
    assert got == brute([(i, t) for i, t, _, _ in EDGE])
    assert M.remove_repeats(empty).count() == 0
    kept = M.remove_repeats(edge, with_text=True).where("doc_id = 5").first().kept
    assert bytes(kept).decode() == EDGE[8][1]


def test_long_text_across_blocks(spark):
    rnd = random.Random(2)
    noise = rnd.randbytes(1_700_000).hex()
    edge = M.BLOCK - 2 * M.LENGTH
    text = noise[:edge - 150] + noise[-5000:-4600] + noise[edge + 250:2 * edge + 100] + noise[:3_000_000][100:700]
    rows = [(1, text), (2, noise[-5000:-4600])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in M.remove_repeats(df).collect()}
    assert got == {1: (400 + 600 + 600, 3), 2: (400, 1)}


def test_loser_tree_merges_front_coded_runs():
    rnd, runs, every = random.Random(1), [], []
    for r in range(7):
        words = sorted("".join(rnd.choice("ab") for _ in range(rnd.randrange(9))).encode() for _ in range(30))
        every += words
        runs.append(M.Run(M.front_code([(w, 0, 0, r, i) for i, w in enumerate(words)])))
    assert [s for s, _ in M.merge(runs)] == sorted(every)
    assert list(M.merge([])) == [] and M.removed_runs([(0, 0), (200, 200), (500, 510)]) == [(0, 400), (500, 710)]


def test_known_prefixes_aren_t_compared(monkeypatch):
    looked = []
    plain = M.shared
    monkeypatch.setattr(M, "shared", lambda a, b, k=0: looked.append((a[:k], b[:k])) or plain(a, b, k))
    words = [b"prefix-" * 20 + bytes([i]) for i in range(40)]
    runs = [M.Run(M.front_code([(w, 0, 0, 0, 0) for w in words[i::4]])) for i in range(4)]
    looked.clear()
    assert [s for s, _ in M.merge(runs)] == words
    assert all(a == b for a, b in looked) and sum(len(a) == 140 for a, b in looked) > len(looked) / 2


def test_place_fields():
    for v in ((0, 1, 0, 0), (2**31 - 1, 101, 100, 65535), (12345, 7, 99, 1)):
        assert M.unpack(M.pack(*v)) == v
