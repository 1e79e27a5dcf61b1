import itertools
import random

import pytest
import xxhash

from tickwise.llm import simhash_dedup as M
from tickwise.llm.components import components
from .conftest import EDGE


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(rows):
    """(fingerprint, component) of (id, text) rows by brute force."""
    fps = [plain(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            root[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[find(i)] = min(d, names.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", names.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_masks_cover_every_pair():
    for radius in (1, 2, 3):
        masks = [m & (1 << 64) - 1 for m in M.covering_masks(radius)]
        for bits in itertools.combinations(range(64), radius):
            flips = sum(1 << b for b in bits)
            assert any(not m & flips for m in masks)


@pytest.mark.parametrize("bucket", [64, 1])
def test_links_equal_brute_force(spark, monkeypatch, bucket):
    """Small buckets by pairs, large ones by one-bit changes: the same components."""
    monkeypatch.setattr(M, "BUCKET", bucket)
    rnd, fps = random.Random(4), set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(15):
            y = x
            for _ in range(rnd.randrange(4)):
                y ^= 1 << rnd.randrange(64)
            fps.add(y - (1 << 64) if y >> 63 else y)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.node: r.root for r in components(M.links(df)).collect()}
    adj = {a: {b for b in fps if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2} for a in fps}
    want = {}
    for a in sorted(fps):
        if a not in want and len(adj[a]) > 1:
            todo = [a]
            while todo:
                b = todo.pop()
                if b not in want:
                    want[b] = a
                    todo += adj[b]
    assert got == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (900, 901)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}
    assert components(edges.limit(0)).count() == 0


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(map(tuple, M.near_duplicates(docs).collect()), key=str)
    assert got == grouped([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark, edge, empty):
    got = sorted(map(tuple, M.near_duplicates(edge).collect()), key=str)
    assert got == grouped([(i, t) for i, t, _, _ in EDGE])
    assert M.near_duplicates(empty).count() == 0 and M.keep_one(empty).columns == empty.columns
    kept = [r.doc_id for r in M.keep_one(edge).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({c for _, _, c in grouped(
        [(i, t) for i, t, _, _ in EDGE]) if c is not None}) and kept.count(None) == 1


def test_one_row_stays_of_groups_without_ids(spark):
    same, other = "one two three four five", "quite another text of its own"
    rows = [(None, same, "a")] * 3 + [(None, same, "b"), (7, same, "c"), (None, other, "d"), (None, other, "d"), (None, other, "e")]
    kept = M.keep_one(spark.createDataFrame(rows, "doc_id long, text string, root string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [(7, same)]
    assert [r.text for r in kept if r.doc_id is None] == [other]


def test_blocks_of_shingles(monkeypatch):
    text = " ".join(str(i % 37) for i in range(500))
    want = M.fingerprint(text)
    monkeypatch.setattr(M, "BLOCK", 16)
    assert M.fingerprint(text) == want == (plain(text) - (1 << 64) if plain(text) >> 63 else plain(text))
