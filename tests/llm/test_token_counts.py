import random

import public_tokenizers
import pytest
import sentencepiece

from tickwise.llm import token_counts as M
from .conftest import EDGE

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return M.PieceVocab.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_every_prefix_equals_library(vocab, library):
    rnd, counter = random.Random(7), M.PrefixCounter(vocab)
    pool = [*"abcdefghilnorstu  \n\t.,AE_-=012éüñ▁日😀\x00\x85<>/", *rnd.sample(sorted(vocab.ranks), 200)]
    for _ in range(400):
        s = "".join(rnd.choice(pool) for _ in range(rnd.randrange(12)))
        want = [len(library.encode(s[:i])) for i in range(len(s) + 1)]
        assert counter.prefixes(s) == want, s
        assert counter.count(s) == want[-1]
        for budget in (0, 1, 3, 7):
            assert counter.fit(s, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_words_of_documents(spark, vocab, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in M.token_counts(docs, vocab).collect()}
    for r in docs.collect():
        n = len(library.encode(r.text))
        assert got[r.doc_id] == (len(r.text.encode()), n, n > 4096)


def test_edges(spark, edge, empty, vocab, library):
    got = sorted(map(tuple, M.token_counts(edge, vocab).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t, _, _ in EDGE]
    assert got == sorted(want, key=str)
    assert M.token_counts(empty, vocab).count() == 0
    cut = {r.doc_id: r for r in M.truncate_to_budget(edge, vocab, 5).collect()}
    assert cut[6].n_tokens <= 5 and "wort wort".startswith(cut[6].prefix[:9])
    table = M.prefix_token_counts(edge.where("doc_id = 5"), vocab).first().counts
    assert table == [len(library.encode(EDGE[8][1][:i])) for i in range(len(EDGE[8][1]) + 1)]


def test_each_vocabulary_has_its_own_counter():
    ranks = {"a": 0, "b": 1, "▁": 2}
    one, two = (M.PieceVocab(ranks, byte_fallback=b) for b in (True, False))
    assert M.counter_for(one) is not M.counter_for(two) and M.counter_for(two) is M.counter_for(two)
