"""Removal of repeated strings by a distributed merge sort of sparse suffixes.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
elsewhere.  Sorting every suffix isn't needed to know that: each window of
``LENGTH`` bytes picks an anchor, the leftmost of its ``GRAM``-byte strings with
the smallest hash, which depends on the window alone, so equal windows have
equal anchors at equal places.  Consecutive windows share an anchor; they form
its span.  Only anchors whose gram occurs again can lie in a repeated window.

1. Anchors of every text, counted by gram hash; those that occur once go.
2. The rest become suffixes: from the anchor to the end of its span, followed
   by the span's bytes before the anchor.  Each task sorts its suffixes into a
   run, in the order of (gram hash, bytes), keeps one of equal ones, front-codes
   it (length of the prefix shared with the one before, then the rest) and
   sends its pieces to ranges of the gram hash, which is even by construction.
3. Each range merges its runs with a loser tree that holds, for every run, the
   prefix shared with the last suffix out.  Unequal shared lengths decide a
   match without looking at bytes; equal ones compare from there on.
4. Suffixes of one gram come out together.  Equal ones are repeated throughout.
   Different ones share windows only where their bytes agree, which is settled
   on the windows' bytes within the gram.
5. Repeated windows go back to their texts by key, and their union is removed.

A gram of more than ``HOT`` anchors isn't gathered in one task: its equal spans
are merged where they are found, and the windows of the others are sent to even
ranges of a 128-bit digest, equal ones merged first.  Its result is the same.

Rows are named by a 64-bit hash of (id, text) and 16 bits of a second one, so
null and repeated ids work, and equal rows repeat each other.  A null text is
empty; texts shorter than ``LENGTH`` can't repeat; long ones are scanned in blocks.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import cut

LENGTH = 200
GRAM = 80
REACH = LENGTH - GRAM + 1      # grams of a window
HOT = 4096
BLOCK = 1 << 20
RUN_BYTES = 32 << 20
LEVEL = 6                      # of the blocks' compression
RANGE_ANCHORS = 200_000        # repeated anchors of a range, on average; it is merged in memory
#: Fields of an anchor's place, packed into 64 bits: start, windows - 1, anchor - start, key bits.
WINDOWS, ANCHOR, EXTRA = 7, 7, 16
ENTRY = struct.Struct("<HHHBqq")
WINDOW_ENTRY = struct.Struct("<16sBqqi")
BASE = 0x9E3779B97F4A7C15
FIRST_BITS = np.uint64(0xFFFFFFFFFFFFFFFF ^ (BLOCK - 1))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for b in (BASE, inverse):
        p = np.ones(BLOCK + 1, np.uint64)
        p[1:] = b
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Scanner:
    def __init__(self) -> None:
        self.up, self.down = _powers()

    def anchors(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text index, gram hash, start, windows, anchor - start) of all spans."""
        held, size = [], 0
        for t, data in enumerate(texts):
            for at in range(0, max(0, len(data) - LENGTH + 1), BLOCK - 2 * LENGTH):
                piece = data[at:at + BLOCK - LENGTH - 1]
                if len(piece) < LENGTH:
                    continue
                if size + len(piece) > BLOCK:
                    yield self._spans(held)
                    held, size = [], 0
                held.append((t, at, piece))
                size += len(piece)
        if held:
            yield self._spans(held)

    def _spans(self, pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * self.down[:n - GRAM + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        low = (h & FIRST_BITS) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while 2 * step <= REACH:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < REACH:
            low = np.minimum(low[:step - REACH], low[REACH - step:])
        # windows that lie in one piece; a piece's last block is shared with the next by LENGTH - 1 bytes
        lens = np.array([len(p) for _, _, p in pieces])
        starts = np.cumsum(lens) - lens
        inner = lens - LENGTH + 1
        which = np.repeat(np.arange(len(pieces)), inner)
        window = np.arange(inner.sum()) + np.repeat(starts - (np.cumsum(inner) - inner), inner)
        at = (low[window] & np.uint64(BLOCK - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (which[1:] != which[:-1])])
        count = np.diff(np.r_[first, len(window)])
        piece, begin = which[first], window[first]
        offset = np.array([a for _, a, _ in pieces]) - starts
        return (np.array([t for t, _, _ in pieces])[piece], h[at[first]].view(np.int64),
                begin + offset[piece], count, at[first] - begin)


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(LEVEL).compress(data)


def expand(block: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(block)


def pack(start, windows, anchor, extra):
    return ((start << WINDOWS | (windows - 1)) << ANCHOR | anchor) << EXTRA | extra


def unpack(place: int) -> tuple[int, int, int, int]:
    place, extra = divmod(place, 1 << EXTRA)
    place, anchor = divmod(place, 1 << ANCHOR)
    start, windows = divmod(place, 1 << WINDOWS)
    return start, windows + 1, anchor, extra


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes needn't be looked at."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    lo, hi = known, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_code(entries: list[tuple[bytes, int, int, int, int]]) -> bytes:
    """Sorted (suffix, split, known, key, place) -> one compressed block."""
    out, last = [], b""
    for s, split, known, key, place in entries:
        k = shared(last, s)
        out += (ENTRY.pack(k, len(s) - k, split, known, key, place), s[k:])
        last = s
    return squeeze(b"".join(out))


class Run:
    """Front-coded entries read forward; ``lcp`` is shared with the one before."""

    def __init__(self, block: bytes):
        self.data, self.at, self.s = expand(block), 0, b""
        self.lcp, self.rest = 0, (0, 0, 0, 0)

    def step(self) -> bool:
        if self.at >= len(self.data):
            return False
        self.lcp, more, split, known, key, place = ENTRY.unpack_from(self.data, self.at)
        self.at += ENTRY.size + more
        self.s = self.s[:self.lcp] + self.data[self.at - more:self.at]
        self.rest = (split, known, key, place)
        return True


def merge(runs: list[Run]) -> Iterator[tuple[bytes, tuple[int, int, int, int]]]:
    """Loser tree over front-coded runs.  ``lcp[r]`` is what the head of run ``r``
    shares with the suffix that beat it, along the path of the last winner the
    last suffix out; bytes before it are never compared again."""
    live = [r for r in runs if r.step()]
    size = 1
    while size < len(live):
        size *= 2
    lcp = [0] * size
    done = [i >= len(live) for i in range(size)]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's lcp becomes that with the winner."""
        if done[a] or done[b]:
            return (b, a) if done[a] else (a, b)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        x, y = live[a].s, live[b].s
        k = shared(x, y, lcp[a])
        if k == len(x) or (k < len(y) and x[k] < y[k]):
            lcp[b] = k
            return a, b
        lcp[a] = k
        return b, a

    losers = [0] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size
        w, losers[node] = play(build(2 * node), build(2 * node + 1))
        return w

    top = build(1) if live else None
    while top is not None and not done[top]:
        run = live[top]
        yield run.s, run.rest
        if run.step():
            lcp[top] = run.lcp
        else:
            done[top] = True
        node = (top + size) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


def _intervals(flags: list[bool]) -> Iterator[tuple[int, int]]:
    begin = None
    for i, f in enumerate([*flags, False]):
        if f and begin is None:
            begin = i
        elif not f and begin is not None:
            yield begin, i - 1
            begin = None


def settle(members: list[tuple[bytes, tuple[int, int, int, int]]]) -> Iterator[tuple[int, int, int, int]]:
    """(key, key bits, first, last repeated window) for the suffixes of one gram, sorted."""
    kinds: dict[tuple[bytes, int], list] = {}    # (suffix, split) -> [known, places]
    for s, (split, known, key, place) in members:
        kind = kinds.setdefault((s, split), [0, []])
        kind[0] |= known
        kind[1].append((key, place, known))
    single = []
    for (s, split), (known, places) in kinds.items():
        if known or len(places) > 1:
            for key, place, told in places:
                if not told:
                    start, windows, _, extra = unpack(place)
                    yield key, extra, start, start + windows - 1
        else:
            single.append((s, split, places[0]))
    if not single or len(kinds) < 2:
        return
    times: dict[bytes, int] = {}
    for s, split in kinds:
        span = s[split:] + s[8:split]
        for i in range(len(span) - LENGTH + 1):
            w = span[i:i + LENGTH]
            times[w] = times.get(w, 0) + 1
    for s, split, (key, place, _) in single:
        span = s[split:] + s[8:split]
        start, windows, _, extra = unpack(place)
        for a, b in _intervals([times[span[i:i + LENGTH]] > 1 for i in range(windows)]):
            yield key, extra, start + a, start + b


class RunMaker:
    """Collects suffixes of a task and sends sorted pieces of them to ranges."""

    def __init__(self, ranges: int):
        self.ranges, self.size = ranges, 0
        self.cold: dict[tuple[bytes, int], list[tuple[int, int]]] = {}
        self.hot: dict[tuple[bytes, int], list[tuple[int, int]]] = {}

    def add(self, key: int, data: bytes, gram: int, place: int, hot: bool) -> None:
        start, windows, anchor, _ = unpack(place)
        end = start + windows + LENGTH - 1
        right = data[start + anchor:end]
        s = (gram & (1 << 64) - 1).to_bytes(8, "big") + right + data[start:start + anchor]
        into = self.hot if hot else self.cold
        into.setdefault((s, 8 + len(right)), []).append((key, place))
        self.size += len(s) + 64

    def flush(self) -> Iterator[tuple[int, int, bytes]]:
        """(range, kind, block): 0 a run of suffixes, 1 windows, 2 intervals already known."""
        found: list[tuple[int, int, int, int]] = []
        pieces: dict[int, list] = {}
        for (s, split), places in sorted(self.cold.items()):
            known = len(places) > 1
            if known:
                found += (self._whole(k, p) for k, p in places)
            r = (int.from_bytes(s[:8], "big") * 0xD6E8FEB86659FD93 & (1 << 64) - 1) * self.ranges >> 64
            pieces.setdefault(r, []).append((s, split, int(known), *places[0]))
        for r, entries in pieces.items():
            yield r, 0, front_code(entries)
        windows: dict[bytes, list[tuple[int, int, int, int]]] = {}
        for (s, split), places in self.hot.items():
            if known := len(places) > 1:
                found += (self._whole(k, p) for k, p in places)
            span = s[split:] + s[8:split]
            key, place = places[0]
            start, n, _, extra = unpack(place)
            for i in range(n):
                d = hashlib.blake2b(span[i:i + LENGTH], digest_size=16).digest()
                windows.setdefault(d, []).append((known, key, start + i, extra))
        parts: dict[int, list[bytes]] = {}
        for d, seen in windows.items():
            known = len(seen) > 1 or seen[0][0]
            if len(seen) > 1:
                found += ((key, extra, at, at) for told, key, at, extra in seen if not told)
            _, key, at, extra = seen[0]
            r = int.from_bytes(d[:8], "big") * self.ranges >> 64
            parts.setdefault(r, []).append(WINDOW_ENTRY.pack(d, known, key, at, extra))
        for r, entries in parts.items():
            yield r, 1, squeeze(b"".join(entries))
        for i in range(0, len(found), 50_000):
            block = np.array(found[i:i + 50_000], np.int64).tobytes()
            yield crc32(block) % self.ranges, 2, squeeze(block)
        self.cold, self.hot, self.size = {}, {}, 0

    @staticmethod
    def _whole(key: int, place: int) -> tuple[int, int, int, int]:
        start, windows, _, extra = unpack(place)
        return key, extra, start, start + windows - 1


def reduce_range(blocks: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """Intervals of repeated windows that one range decides."""
    gram, members = None, []
    for s, rest in merge([Run(b) for kind, b in blocks if kind == 0]):
        if s[:8] != gram:
            yield from settle(members)
            gram, members = s[:8], []
        members.append((s, rest))
    yield from settle(members)
    windows: dict[bytes, list] = {}
    for kind, b in blocks:
        if kind == 1:
            for d, known, key, at, extra in WINDOW_ENTRY.iter_unpack(expand(b)):
                windows.setdefault(d, []).append((known, key, extra, at))
        elif kind == 2:
            yield from map(tuple, np.frombuffer(expand(b), np.int64).reshape(-1, 4).tolist())
    for seen in windows.values():
        if len(seen) > 1 or seen[0][0]:
            for known, key, extra, at in seen:
                if not known:
                    yield key, extra, at, at


def removed_runs(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal byte runs covered by the windows that start in the intervals."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + LENGTH)
        else:
            out.append([a, b + LENGTH])
    return [(a, b) for a, b in out]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"),
                       F.xxhash64(F.col(id_col), text).alias("key"),
                       F.crc32(text.cast("binary")).bitwiseAND(F.lit((1 << EXTRA) - 1)).cast("int").alias("extra"))


def repeated_windows(keyed: DataFrame, hot: int = HOT) -> DataFrame:
    """(key, extra, first, last): intervals of windows that start elsewhere, too."""
    spark = keyed.sparkSession

    def scan(batches):
        scanner = Scanner()
        for b in batches:
            keys, extra = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)
            texts = [t.as_py().encode() for t in b.column(2)]
            for t, gram, start, windows, anchor in scanner.anchors(texts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(keys[t]), pa.array(pack(start, windows, anchor, extra[t]))],
                    names=["gram", "key", "place"])

    def runs(batches):
        maker = RunMaker(ranges)

        def out():
            rows = list(maker.flush())
            for i in range(0, len(rows), 256):
                part = list(zip(*rows[i:i + 256], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()), pa.array(part[2], pa.binary())],
                    names=["range", "kind", "block"])

        for b in batches:
            for i in range(b.num_rows):
                key, data = b.column(0)[i].as_py(), b.column(2)[i].as_py().encode()
                spans = b.column(3)[i].values
                for gram, place, is_hot in zip(spans.field(0).to_pylist(), spans.field(1).to_pylist(),
                                               spans.field(2).to_pylist(), strict=True):
                    maker.add(key, data, gram, place, is_hot)
                if maker.size >= RUN_BYTES:
                    yield from out()
        yield from out()

    def decide(table: pa.Table) -> pa.Table:
        blocks = list(zip(table.column("kind").to_pylist(), table.column("block").to_pylist(), strict=True))
        got = np.array(list(reduce_range(blocks)), np.int64).reshape(-1, 4)
        return pa.table({"key": got[:, 0], "extra": got[:, 1].astype(np.int32), "first": got[:, 2], "last": got[:, 3]})

    anchors = keyed.select("key", "extra", "text").mapInArrow(scan, "gram long, key long, place long")
    # written, so that both sides of the join are dealt out for it, and a hot gram can be split
    again = cut(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "suffix-grams")
    repeated = again.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-repeated // RANGE_ANCHORS))
    found = anchors.join(again.select("gram", (F.col("n") > hot).alias("hot")), "gram").groupBy(
        "key", F.col("place").bitwiseAND(F.lit((1 << EXTRA) - 1)).cast("int").alias("extra")) \
        .agg(F.collect_set(F.struct("gram", "place", "hot")).alias("spans"))
    # the id travels along so that both joins on the texts share one exchange
    texts = keyed.join(found, ["key", "extra"]).select("key", "id", "text", "spans")
    return texts.mapInArrow(runs, "range int, kind int, block binary").groupBy("range") \
        .applyInArrow(decide, "key long, extra int, first long, last long")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT,
                   with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, and
    with ``with_text`` the kept bytes as ``kept``."""
    ship_package(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    windows = repeated_windows(keyed, hot).groupBy("key", "extra").agg(
        F.collect_list(F.struct("first", "last")).alias("windows"))
    joined = keyed.join(windows, ["key", "extra"], "left").select("id", "text", "windows", "key")

    def remove(batches):
        for b in batches:
            n, gone, spans, sha, kept = [], [], [], [], []
            for text, w in zip(b.column(1), b.column(2), strict=True):
                data = text.as_py().encode()
                runs = removed_runs([(x["first"], x["last"]) for x in w.as_py()]) if w.is_valid else []
                out, at = [], 0
                for a, z in runs:
                    out.append(data[at:a])
                    at = z
                rest = b"".join([*out, data[at:]]) if runs else data
                n.append(len(data))
                gone.append(len(data) - len(rest))
                spans.append(len(runs))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
                    pa.array(sha, pa.string())]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(remove, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                             + (", kept binary" if with_text else ""))
