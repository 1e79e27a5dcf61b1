import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickwise.llm import bpe_codec as M
from .conftest import EDGE

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def bpe():
    return M.ByteBpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_segment_tree_equals_plain_merging(bpe):
    rnd = random.Random(3)
    for _ in range(300):
        ids = [bpe.byte_ids[rnd.choice(b"aabeinrst  ")] for _ in range(rnd.randrange(40))]
        plain = list(ids)
        while pairs := [(bpe.merges[p][0], i) for i in range(len(plain) - 1) if (p := (plain[i], plain[i + 1])) in bpe.merges]:
            _, i = min(pairs)
            plain[i:i + 2] = [bpe.merges[plain[i], plain[i + 1]][1]]
        assert M.merge_ids(ids, bpe.merges) == plain


def test_equals_library(bpe, library):
    rnd, codec = random.Random(5), M.Codec(bpe)
    pool = [*"abc  \n\t'stl.,12éü日😀\x00\x85\x1c​᠎½Ⅷ<|>՘", "<|endoftext|>", "'ll", "<|endof", "    ", "!!!!"]
    for _ in range(3000):
        s = "".join(rnd.choice(pool) for _ in range(rnd.randrange(16)))
        ids = library.encode(s, add_special_tokens=False).ids
        assert list(codec.encode(s)) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    some = [rnd.randrange(50257) for _ in range(2000)]   # not always UTF-8
    for k in range(0, 2000, 5):
        assert codec.decode(some[k:k + 5]) == library.decode(some[k:k + 5], skip_special_tokens=False)


def test_edges_and_round_trip(edge, empty, bpe, library):
    got = sorted(map(tuple, M.round_trip(edge, bpe).collect()), key=str)
    want = []
    for i, t, _, _ in EDGE:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert M.round_trip(empty, bpe).count() == 0
    back = M.decode(M.encode(edge, bpe), bpe).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t, _, _ in EDGE), key=str)
