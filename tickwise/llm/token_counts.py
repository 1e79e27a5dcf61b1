"""Token counts by prefix dynamic programming over a BPE piece vocabulary.

In BPE the encoding of a prefix is decided by its last token: if ``t`` ends
the encoding of ``s[:i]`` then the tokens before it are exactly the encoding
of ``s[:i - len(t)]``, and a token sequence is an encoding iff every adjacent
pair re-encodes to itself.  One pass therefore fills, for every prefix, its
last token and its exact token count; truncation and budget questions are
answered from that table without encoding anything again.

No piece has a word mark after another character, and a character that is in
no longer piece never merges, so a text falls into independent chunks whose
counts are cached per Python worker (bounded) and added up; a chunk that isn't
there is cut again between characters that no piece has side by side.

Nulls count as empty texts (0 tokens), null ids are kept, repeated rows give
repeated rows, columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, rows_batch

MARK = "▁"
CACHE_ENTRIES = 600_000   # chunks, and their parts, kept per Python worker
NEVER = 1 << 60
UNREACHED = ("", "")
CACHE_CHARS = 48          # longer chunks are computed each time


@dataclass(frozen=True)
class PieceVocab:
    """Pieces by merge priority; the fields are plain data and travel in a closure."""

    ranks: dict[str, int]
    byte_fallback: bool = True
    dummy_prefix: bool = True
    longest: int = field(default=1)

    @classmethod
    def load(cls, model_path: str) -> PieceVocab:
        """Read on the driver; workers get the pieces, not the file."""
        import sentencepiece as sp

        m = sp.SentencePieceProcessor(model_file=model_path)
        ids = [i for i in range(m.get_piece_size())
               if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i) or m.is_unused(i))]
        order = sorted({m.get_score(i) for i in ids}, reverse=True)
        rank = {s: r for r, s in enumerate(order)}
        ranks = {m.id_to_piece(i): rank[m.get_score(i)] for i in ids}
        return cls(ranks, any(m.is_byte(i) for i in range(m.get_piece_size())),
                   bool(m.encode("a", out_type=str)[0].startswith(MARK)),
                   max(map(len, ranks), default=1))


class PrefixCounter:
    """Exact token counts of every prefix under a :class:`PieceVocab`."""

    def __init__(self, vocab: PieceVocab):
        self.v = vocab
        self._splits: dict[str, tuple[str, str] | None] = {}   # one entry a piece
        self._pairs: dict[tuple[str, str], bool] = {}
        self.reached = {p for p in vocab.ranks if self._parts(p) != UNREACHED}
        self.tails = {p[i:] for p in self.reached for i in range(len(p))}
        self.neighbours = {p[i:i + 2] for p in self.reached for i in range(len(p) - 1)}
        self.totals, self.part_totals = _Bounded(self._chunk_total), _Bounded(self._part_total)
        joined = {c for p in vocab.ranks if len(p) > 1 for c in p} - {MARK}
        inner = any(MARK in p.lstrip(MARK) for p in vocab.ranks)
        cls = "".join(re.escape(c) for c in sorted(joined)) or MARK
        self.chunks = re.compile("(?s:.+)" if inner else f"{MARK}*[{cls}]+|{MARK}+|(?s:.)").findall

    def normal(self, text: str) -> str:
        if not text:
            return ""
        s = text.replace(" ", MARK)
        return MARK + s if self.v.dummy_prefix else s

    def _parts(self, piece: str) -> tuple[str, str] | None:
        """The two pieces of the last merge that makes ``piece``; None for a single
        character, and ``("", "")`` for a piece that merging never reaches."""
        got = self._splits.get(piece, 0)
        if got == 0:
            got, parts, ranks = None, list(piece), self.v.ranks
            while len(parts) > 1:
                best, at = min((ranks.get(a + b, NEVER), i)
                               for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if best == NEVER:
                    got = UNREACHED
                    break
                got = parts[at], parts[at + 1]
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self._splits[piece] = got
        return got

    def _fits(self, a: str, b: str) -> bool:
        """Whether ``a`` and ``b`` stay apart when ``a + b`` is merged: undo their
        merges from the latest back, and see that no merge across the boundary
        would have come before; a merge on the left wins among equals."""
        ok = self._pairs.get((a, b))
        if ok is None:
            rank, x, y, before = self.v.ranks.get, a, b, NEVER
            ok = True
            while True:
                if rank(x + y, NEVER) < before:
                    ok = False
                    break
                p, q = self._parts(x), self._parts(y)
                if p and (not q or rank(x) > rank(y)):
                    before, x = rank(x), p[1]
                elif q:
                    before, y = rank(y) + 1, q[0]
                else:
                    break
            if len(self._pairs) > 4 * CACHE_ENTRIES:
                self._pairs.clear()
            self._pairs[a, b] = ok
        return ok

    def _cost(self, token: str) -> int:
        if token in self.v.ranks:
            return 1
        return len(token.encode()) if self.v.byte_fallback else 1

    def table(self, chunk: str) -> list[int]:
        """``table[i]``: tokens of ``chunk[:i]``, for every ``i``."""
        reached, tails, pairs, fits = self.reached, self.tails, self._pairs, self._fits
        last, count = [""] * (len(chunk) + 1), [0] * (len(chunk) + 1)
        for i in range(1, len(chunk) + 1):
            j = i - 1
            while j >= 0 and (t := chunk[j:i]) in tails:
                if t in reached:
                    if not j:
                        break
                    ok = pairs.get((last[j], t))
                    if ok or (ok is None and fits(last[j], t)):
                        break
                j -= 1
            else:   # a character without a piece stays alone
                j = i - 1
                t = chunk[j:i]
            last[i], count[i] = t, count[j] + (1 if t in reached else self._cost(t))
        return count

    def _part_total(self, part: str) -> int:
        return self.table(part)[-1]

    def _chunk_total(self, chunk: str) -> int:
        near, begin, n = self.neighbours, 0, 0
        for i in range(1, len(chunk)):
            if chunk[i - 1:i + 1] not in near:
                n += self.part_totals[chunk[begin:i]]
                begin = i
        return n + self.part_totals[chunk[begin:]]

    def count(self, text: str | None) -> int:
        return sum(map(self.totals.__getitem__, self.chunks(self.normal(text or ""))))

    def prefixes(self, text: str | None) -> list[int]:
        """Tokens of ``text[:i]`` for every ``i`` from 0 to ``len(text)``."""
        out, base = [0], 0
        for c in self.chunks(self.normal(text or "")):
            t = self.table(c)
            out += [base + n for n in t[1:]]
            base += t[-1]
        if text and self.v.dummy_prefix:   # the mark in front is no prefix of the text
            del out[1]
        return out

    def fit(self, text: str | None, budget: int) -> int:
        """Length of the longest prefix that has at most ``budget`` tokens."""
        counts = self.prefixes(text)
        return next(i for i in range(len(counts) - 1, -1, -1) if counts[i] <= budget or not i)


class _Bounded(dict):
    """Computes what is missing; emptied when full, and long keys aren't kept."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key: str) -> int:
        n = self.compute(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[key] = n
        return n


_COUNTERS: dict[int, PrefixCounter] = {}


def counter_for(vocab: PieceVocab) -> PrefixCounter:
    """The worker's counter for a vocabulary; the last one stays between tasks."""
    key = hash((tuple(vocab.ranks.items()), vocab.byte_fallback, vocab.dummy_prefix, vocab.longest))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PrefixCounter(vocab)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, vocab: PieceVocab, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 4096) -> DataFrame:
    """One row per input row: id, UTF-8 bytes, tokens, whether over ``limit``."""
    def make():
        counter = counter_for(vocab)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t.as_py() or "" for t in b.column(1)]
            n = [counter.count(t) for t in texts]
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), make,
                       f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def prefix_token_counts(docs: DataFrame, vocab: PieceVocab, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """The whole table per row: ``counts[i]`` = tokens of the first ``i`` code points."""
    def make():
        counter = counter_for(vocab)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([counter.prefixes(t.as_py()) for t in b.column(1)],
                                       pa.list_(pa.int32()))], names=[id_col, "counts"])
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, counts array<int>")


def truncate_to_budget(docs: DataFrame, vocab: PieceVocab, budget: int, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """The longest prefix of each text within ``budget`` tokens, and its count."""
    def make():
        counter = counter_for(vocab)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t.as_py() or "" for t in b.column(1)]
            cuts = [t[:counter.fit(t, budget)] for t in texts]
            return rows_batch([id_col, "prefix", "n_tokens"],
                              [b.schema.field(0).type, pa.string(), pa.int64()],
                              [b.column(0), cuts, [counter.count(c) for c in cuts]])
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), make,
                       f"`{id_col}` {kind}, prefix string, n_tokens long")
