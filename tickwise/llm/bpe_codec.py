"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

Leaf ``i`` of the tree holds the merge rank of the pair that starts at symbol
``i``; every inner node holds the smaller of its children.  The root is the
lowest rank, and going left on ties leads to the leftmost pair with it.  A
merge changes three leaves (the merged pair, the pair before it and the symbol
that went), each a point update of logarithmic cost, until the root says that
no pair can be merged.

Null texts are empty; a special string inside a text becomes its id, as in the
library's default; nothing is truncated or padded; lengths are unbounded.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches

NONE = 1 << 30
CACHE_ENTRIES = 600_000   # pieces kept per Python worker
CACHE_CHARS = 48
#: Fixed value: the public pattern that cuts a text before the merges.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Blocks in which all Unicode versions agree on letters, digits and spaces; a
#: text with any other character is cut by the library's own pre-tokenizer.
SETTLED = ("\x00-\u052f\u2000-\u2064\u20a0-\u20b0\u2190-\u23ff\u3041-\u3096\u30a1-\u30fe"
           "\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f5ff")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@dataclass(frozen=True)
class ByteBpe:
    """A byte-level vocabulary as plain data."""

    merges: dict[tuple[int, int], tuple[int, int]]   # pair -> (rank, merged id)
    byte_ids: list[int]
    token_bytes: dict[int, bytes]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> ByteBpe:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        back = {c: b for b, c in letters.items()}
        merges = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        tokens = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}
        tokens |= {i: t.encode() for t, i in special.items()}
        return cls(merges, [vocab[letters[b]] for b in range(256)], tokens, special)


def merge_ids(ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge to the end: lowest rank first, leftmost among equals."""
    n = len(ids)
    if n < 2:
        return ids
    ids, size = list(ids), 1
    while size < n - 1:
        size *= 2
    tree = [NONE] * (2 * size)
    get = merges.get
    for i in range(n - 1):
        m = get((ids[i], ids[i + 1]))
        if m:
            tree[size + i] = m[0]
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, rank: int) -> None:
        i += size
        tree[i] = rank
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            low = a if a <= b else b
            if tree[i] == low:
                break
            tree[i] = low
            i >>= 1

    while tree[1] != NONE:
        low, i = tree[1], 1
        while i < size:
            i *= 2
            if tree[i] != low:
                i += 1
        i -= size
        j = after[i]
        k = after[j]
        ids[i] = get((ids[i], ids[j]))[1]
        ids[j], after[i] = -1, k
        if j < n - 1:
            put(j, NONE)
        if k < n:
            before[k] = i
            m = get((ids[i], ids[k]))
            put(i, m[0] if m else NONE)
        else:
            put(i, NONE)
        p = before[i]
        if p >= 0:
            m = get((ids[p], ids[i]))
            put(p, m[0] if m else NONE)
    return [x for x in ids if x >= 0]


class Codec:
    def __init__(self, bpe: ByteBpe):
        import regex

        self.bpe = bpe
        from tokenizers.pre_tokenizers import ByteLevel

        self._fast = regex.compile(PIECES).findall
        self._unsettled = re.compile(f"[^{SETTLED}]").search
        self._library = ByteLevel(add_prefix_space=False).pre_tokenize_str
        names = sorted(bpe.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self._packed: dict[str, bytes] = _Packed(self)

    def pieces(self, text: str) -> list[str]:
        if not self._unsettled(text):
            return self._fast(text)
        return [text[a:z] for _, (a, z) in self._library(text)]

    def ids_of(self, piece: str) -> list[int]:
        start = self.bpe.byte_ids
        return merge_ids([start[b] for b in piece.encode()], self.bpe.merges)

    def pack(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.special or not any(s in text for s in self.bpe.special):
            return b"".join(map(self._packed.__getitem__, self.pieces(text)))
        out = []
        for k, part in enumerate(self.special.split(text)):
            out.append(self.bpe.special[part].to_bytes(4, "little") if k % 2
                       else b"".join(map(self._packed.__getitem__, self.pieces(part))))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return unpack(self.pack(text))

    def decode(self, ids) -> str:
        """Bytes of the tokens in order; what isn't UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bpe.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def unpack(packed: bytes) -> array:
    ids = array("I", packed)
    if ids.itemsize != 4:
        raise RuntimeError("32-bit ids expected")
    import sys
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


class _Packed(dict):
    def __init__(self, owner: Codec):
        super().__init__()
        self.owner = owner

    def __missing__(self, piece: str) -> bytes:
        packed = b"".join(i.to_bytes(4, "little") for i in self.owner.ids_of(piece))
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = packed
        return packed


_CODECS: dict[int, Codec] = {}


def codec_for(bpe: ByteBpe) -> Codec:
    """The worker's codec for a vocabulary; the last one stays between tasks."""
    key = hash((tuple(bpe.byte_ids), tuple(bpe.merges.items()), tuple(bpe.special.items())))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(bpe)
    return _CODECS[key]


def encode(docs: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ``ids`` (array of int)."""
    def make():
        codec = codec_for(bpe)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([codec.encode(t.as_py() or "") for t in b.column(1)],
                                       pa.list_(pa.int32()))], names=[id_col, "ids"])
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id and ``text``; null ids give an empty text."""
    def make():
        codec = codec_for(bpe)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([codec.decode(t.as_py() or []) for t in b.column(1)],
                                       pa.string())], names=[id_col, "text"])
        return step

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_batches(encoded.select(id_col, ids_col), make, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the ids and of the text decoded from them, one row per input row."""
    def make():
        codec = codec_for(bpe)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_sha, text_sha = [], [], []
            for t in b.column(1):
                packed = codec.pack(t.as_py() or "")
                text = codec.decode(unpack(packed))
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), make,
                       f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
