"""Phrases whose words occur together more often than their parts, per language.

Texts become shards of numbered words (``word_shards``).  Every shard gets an
FM-index over its word ids, forwards and of its reverse: the word before each
suffix in sorted order (BWT) and the LF mapping.  Suffixes are sorted by their
first ``LONGEST`` words only, which is all that extensions up to that depth
need.  A phrase is a pair of intervals, one in each index; one step extends
all phrases of a shard to the right or to the left and gives the count of every
extension, so n-grams are enumerated with their counts, and sums over shards
are exact.

Only phrases that can still reach the least count are extended: words, then
pairs, are summed over all shards first, and shards get back which of theirs
occur often enough (a phrase can't occur more often than a part of it).
Triples are pairs extended to the right, quadruples are triples extended to the
left, and both must consist of frequent pairs.

Frequencies of parts are carried along with the pairs, so no join is keyed on
a single word, and the shuffled rows hold numbers, not strings.  Counts are summed
in buckets of words and phrases: a shard's words or phrases of one bucket travel as
one row of compressed sorted arrays, and the number of buckets grows with the words, so
that a bucket stays of one size.  Ids of words follow their frequency, frequent words
come first, which keeps the arrays of ids small.

A null text is empty, a null language is ``und``.  Equal scores are ordered by
count, then by the phrase's bytes.  Pieces longer than a shard are held whole
by one task; all other texts are cut at piece ends.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import cut, release, remove, stored
from .word_shards import SHARD_WORDS, Numbering, pack, shard_names, unpack

LONGEST = 4
LEAST = 30          # occurrences of a candidate
COVERED = 80        # percent of a candidate's occurrences that a longer one takes over
TOP = 2000
SCALE = 2_000_000
BUCKET = 1 << 21    # words of the corpus to a bucket of phrases
BLOCK = 1 << 23     # bytes of a text that are split at once

#: Lower case, one blank, one separator.
_CLASSES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"." * 9)
_END = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")


def words_of(text: bytes) -> list[bytes]:
    """Words in order; ``.`` ends a piece and stands nowhere else."""
    return (text.translate(_CLASSES).replace(b".", b" . ") + b" .").split()


def blocks(text: bytes):
    """Parts of about ``BLOCK`` bytes that end with pieces."""
    at = 0
    while at < len(text):
        end = _END.search(text, at + BLOCK)
        stop = end.end() if end else len(text)
        yield text[at:stop]
        at = stop


def _order(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of the circular ``t`` by their first ``depth`` (a power of two) words."""
    width, rank = 1, t
    while True:
        rank = rank * (int(rank.max()) + 1) + np.roll(rank, -width)
        width *= 2
        if width >= depth:
            return np.argsort(rank, kind="stable")
        rank = np.unique(rank, return_inverse=True)[1]


class Index:
    """One direction: the word before each suffix, and where that longer suffix stands."""

    def __init__(self, bwt: np.ndarray):
        self.bwt = bwt
        self.lf = np.empty(len(bwt), np.int64)
        self.lf[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))

    @classmethod
    def of(cls, t: np.ndarray) -> Index:
        return cls(t[_order(t, LONGEST) - 1])

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the interval of every word, by number (0 is the separator)."""
        n = np.bincount(self.bwt)
        return np.cumsum(n) - n, n

    def extend(self, lo: np.ndarray, other: np.ndarray, n: np.ndarray):
        """All one-word extensions of the phrases with interval ``lo``, size ``n`` and start
        ``other`` in the opposite index: (parent, word, lo, other, n), separators left out."""
        if not len(lo):
            none = np.zeros(0, np.int64)
            return none, none, none, none, none
        base = np.cumsum(n) - n
        parent = np.repeat(np.arange(len(lo)), n)
        row = np.arange(len(parent)) + np.repeat(lo - base, n)
        key = parent * (int(self.bwt.max()) + 1) + self.bwt[row]
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        row, parent = row[order[start]], parent[start]
        word = self.bwt[row]
        # in the other index the extensions follow each other by word
        found = parent, word, self.lf[row], other[parent] + start - base[parent], size
        return tuple(a[word > 0] for a in found)


def pack_words(words: list[bytes]) -> bytes:
    """Words compressed; none holds a blank."""
    text = b" ".join([*words, b""])
    return len(text).to_bytes(8, "little") + pa.Codec("zstd").compress(text, asbytes=True)


def unpack_words(b: bytes) -> pa.Array:
    """The words of ``pack_words``, each with a blank at its end."""
    n = int.from_bytes(b[:8], "little")
    text = pa.Codec("zstd").decompress(b[8:], n) if n else pa.py_buffer(b"")
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.append(0, ends)), text])


def coded(langs: list[str], code: np.ndarray) -> tuple[list[str], bytes]:
    """The languages that occur in ``code``, and the places among these."""
    present, code = np.unique(code, return_inverse=True)
    return [langs[i] for i in present], pack(code)


def decoded(table: pa.Table) -> tuple[list[str], list[np.ndarray]]:
    """All languages of the rows (``coded``), and each row's places among these."""
    rows = table["langs"].to_pylist()
    langs = sorted({k for row in rows for k in row})
    place = {k: i for i, k in enumerate(langs)}
    return langs, [np.array([place[k] for k in row], np.int64)[unpack(c)]
                   for row, c in zip(rows, table["code"].to_pylist(), strict=True)]


def shards(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """One row a shard: the text as numbers, 0 between pieces, its languages with their words' occurrences, and
    its words by number, frequent ones first, with the places of their languages (arrays)."""
    ship_package(docs.sparkSession)

    def row(name, numbers, parts):
        t = np.concatenate(parts)
        pairs = numbers.pairs()
        n = np.bincount(t, minlength=len(pairs) + 1)
        order = np.argsort(-n[1:], kind="stable")
        place = np.zeros(len(n), np.int64)
        place[order + 1] = np.arange(1, len(n))
        langs = {k: i for i, k in enumerate(sorted({k for k, _ in pairs}))}
        code = np.fromiter((langs[k] for k, _ in pairs), np.int64, len(pairs))
        total = np.zeros(len(langs), np.int64)
        np.add.at(total, code, n[1:])
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.array([pack(place[t])], pa.binary()),
             pa.array([[{"lang": k, "n": int(total[i])} for k, i in langs.items()]], lang_type),
             pa.array([pack(code[order])], pa.binary()),
             pa.array([pack_words([pairs[i][1] for i in order])], pa.binary())],
            names=["shard", "ids", "langs", "code", "words"])

    lang_type = pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())]))

    def run(batches):
        names, numbers, parts, size = shard_names(), Numbering(), [], 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for part in blocks(text.as_buffer().to_pybytes() if text.is_valid else b""):
                    t = numbers.of(lang, words_of(part))
                    t[t == t[-1]] = 0      # the last one is a separator
                    parts.append(t)
                    size += len(t)
                    if size >= SHARD_WORDS:
                        yield row(next(names), numbers, parts)
                        numbers, parts, size = Numbering(), [], 0
        if size:
            yield row(next(names), numbers, parts)

    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, "shard long, ids binary, langs array<struct<lang: string, n: long>>, code binary, words binary")


def word_counts(shard_rows: DataFrame, buckets: int) -> DataFrame:
    """(shard, bucket, langs, code, words, number, n): the words of every shard by bucket, in order of their language
    and bytes, with their numbers and occurrences in the shard; the last four are arrays."""
    names = ["shard", "bucket", "langs", "code", "words", "number", "n"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.string()), *[pa.binary()] * 4]

    def run(batches):
        for b in batches:
            for shard, ids, langs, code, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                code, words = unpack(code), unpack_words(words)
                n = np.bincount(unpack(ids), minlength=len(words) + 1)[1:]
                bucket = np.fromiter(map(zlib.crc32, words.to_pylist()), np.int64, len(words)) % buckets
                order = np.asarray(pc.sort_indices(words)).astype(np.int64)
                order = order[n[order] > 0]
                order = order[np.lexsort((code[order], bucket[order]))]
                ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
                rows = []
                for lo, hi in zip(np.append(0, ends[:-1]), ends, strict=False):
                    own = order[lo:hi]
                    rows.append((shard, int(bucket[own[0]]), *coded(langs, code[own]),
                                 pack_words([w[:-1] for w in words.take(own).to_pylist()]), pack(own + 1), pack_long(n[own])))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    return shard_rows.select("shard", "ids", "langs.lang", "code", "words").mapInArrow(
        run, "shard long, bucket long, langs array<string>, code binary, words binary, number binary, n binary")


def frequent_words(counts: DataFrame, least: int, buckets: int) -> DataFrame:
    """(shard, langs, code, number, id, f, words): the words of every shard with ``least`` occurrences in all of them,
    by rising id: their languages, numbers in the shard, ids (steps) and occurrences in all; and, with no shard,
    the ids and the words themselves once.  All but the first two are arrays."""
    names = ["shard", "langs", "code", "number", "id", "f", "words"]
    schema = pa.schema([*zip(names, [pa.int64(), pa.list_(pa.string()), *[pa.binary()] * 5], strict=True)])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        langs, code = decoded(table)
        number = np.concatenate([unpack(b) for b in table["number"].to_pylist()])
        n = np.concatenate([unpack_long(b) for b in table["n"].to_pylist()])
        words = pa.concat_arrays([unpack_words(b) for b in table["words"].to_pylist()]).dictionary_encode()
        lengths = [len(c) for c in code]
        code = np.concatenate(code)
        found, which = np.unique(np.asarray(words.indices).astype(np.int64) * len(langs) + code, return_inverse=True)
        f = np.zeros(len(found), np.int64)
        np.add.at(f, which, n)
        order = np.argsort(-f, kind="stable")[:np.count_nonzero(f >= least)]
        ids = np.zeros(len(found), np.int64)
        ids[order] = np.arange(len(order)) * buckets + key[0].as_py() + 1
        if not len(order):
            return schema.empty_table()
        spelt = words.dictionary.take(found[order] // len(langs)).to_pylist()
        rows, at = [(None, [], None, None, pack_long(np.diff(ids[order], prepend=0)), None,
                     pack_words([w[:-1] for w in spelt]))], 0
        for shard, size in zip(table["shard"].to_pylist(), lengths, strict=True):
            own = at + np.flatnonzero(ids[which[at:at + size]])
            at += size
            own = own[np.argsort(ids[which[own]])]
            if len(own):
                rows.append((shard, *coded(langs, code[own]), pack(number[own]),
                             pack_long(np.diff(ids[which[own]], prepend=0)), pack_long(f[which[own]]), None))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)

    return counts.groupBy("bucket").applyInArrow(
        run, "shard long, langs array<string>, code binary, number binary, id binary, f binary, words binary")


def spelt_words(known: DataFrame) -> DataFrame:
    """(id, word) of all words of ``frequent_words``."""
    def run(batches):
        for b in batches:
            for ids, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                word = pc.utf8_rtrim(unpack_words(words).cast(pa.large_string()), " ").cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(np.cumsum(unpack_long(ids))), word], names=["id", "word"])

    return known.where("shard IS NULL").select("id", "words").mapInArrow(run, "id long, word string")


def _frequent_text(t: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """``t`` renumbered to the places of ``numbers`` from 1; other words separate, like piece ends."""
    place = np.zeros(int(t.max(initial=0)) + 1, np.int64)
    place[numbers] = np.arange(1, len(numbers) + 1)
    t = place[t]
    keep = np.ones(len(t), bool)
    keep[1:] = (t[1:] > 0) | (t[:-1] > 0)
    return np.append(t[keep], 0)


def _pairs(forward: Index, reverse: Index):
    """All pairs of words: (first, second, lo, reverse lo, count)."""
    lo, n = forward.words()
    first, second, rlo, flo, size = reverse.extend(lo[1:], lo[1:], n[1:])
    return first + 1, second, flo, rlo, size


def frequent_shards(shard_rows: DataFrame, words: DataFrame) -> DataFrame:
    """One row a shard: its text over the frequent words, numbered from 1 by rising id, and for these words the
    places of their languages, their ids (steps) and their occurrences in all shards (arrays).
    ``words``: the frequent words of every shard (``frequent_words``)."""
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        langs, code = decoded(right)
        code = np.concatenate(code)
        number = np.concatenate([unpack(b) for b in right["number"].to_pylist()])
        ids = np.concatenate([np.cumsum(unpack_long(b)) for b in right["id"].to_pylist()])
        f = np.concatenate([unpack_long(b) for b in right["f"].to_pylist()])
        order = np.argsort(ids)
        row = (key[0].as_py(), pack(_frequent_text(unpack(left["ids"][0].as_py()), number[order])), langs,
               pack(code[order]), pack_long(np.diff(ids[order], prepend=0)), pack_long(f[order]))
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types, strict=True)], schema=schema)

    schema = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("langs", pa.list_(pa.string())),
                        ("code", pa.binary()), ("id", pa.binary()), ("f", pa.binary())])
    return (shard_rows.select("shard", "ids").groupBy("shard").cogroup(
        words.where("shard IS NOT NULL").select(F.col("shard").alias("owner"), "langs", "code", "number", "id", "f")
        .groupBy("owner")).applyInArrow(
        run, "shard long, ids binary, langs array<string>, code binary, id binary, f binary"))


def pack_long(a: np.ndarray) -> bytes:
    """``pack`` for 64-bit numbers: the low and the high halves."""
    halves = np.ascontiguousarray(a, "<i8").view("<u4")
    return pack(np.concatenate([halves[::2], halves[1::2]]))


def unpack_long(b: bytes) -> np.ndarray:
    low, high = np.split(unpack(b), 2)
    return low | high << 32


def bucketed(ids: list[np.ndarray], values: np.ndarray, buckets: int):
    """The phrases of one shard by bucket, sorted: (bucket, ids, value) of each bucket that has some."""
    mixed = np.zeros(len(values), np.uint64)
    for a in ids:
        mixed = (mixed + a.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    bucket = (mixed % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((*ids[::-1], bucket))
    bucket, ids, values = bucket[order], [a[order] for a in ids], values[order]
    ends = np.flatnonzero(np.concatenate([bucket[1:] != bucket[:-1], [True]])[: len(bucket)]) + 1
    for lo, hi in zip(np.concatenate([[0], ends[:-1]]), ends, strict=False):
        yield int(bucket[lo]), [a[lo:hi] for a in ids], values[lo:hi]


def packed_row(ids: list[np.ndarray], values: np.ndarray) -> list[bytes]:
    """Sorted phrases: the steps of the first words, the other words, the values."""
    return [pack_long(np.diff(ids[0], prepend=0)), *map(pack_long, ids[1:]), pack_long(values)]


def unpacked_rows(columns) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of ``packed_row`` to arrays over all rows, and the length of each row."""
    first, *others = ([unpack_long(b.as_py()) for b in c] for c in columns)
    arrays = [np.concatenate([*parts, np.zeros(0, np.int64)]) for parts in ([np.cumsum(d) for d in first], *others)]
    return arrays, np.array([len(d) for d in first], np.int64)


def pair_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """(shard, bucket, g1, g2, n): the pairs of every shard, each the extension of a word to the right;
    the last three are arrays (``packed_row``)."""
    def run(batches):
        for b in batches:
            for shard, packed, words in zip(b.column(0), b.column(1), b.column(2), strict=True):
                reverse = Index.of(unpack(packed.as_py())[::-1])
                lo, n = reverse.words()
                first, second, _, _, n = reverse.extend(lo[1:], lo[1:], n[1:])
                ids = np.cumsum(unpack_long(words.as_py()))
                rows = [(shard.as_py(), at, *packed_row(g, m))
                        for at, g, m in bucketed([ids[first], ids[second - 1]], n, buckets)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 2 + [pa.binary()] * 3, strict=True)],
                        names=["shard", "bucket", "g1", "g2", "n"])

    return texts.select("shard", "ids", "id").mapInArrow(run, "shard long, bucket long, g1 binary, g2 binary, n binary")


def frequent_pairs(counts: DataFrame, least: int) -> DataFrame:
    """(shard, g1, g2, f): the pairs of every shard with ``least`` occurrences in all of them, as arrays;
    f is their number in the first shard that has them, 0 in the others."""
    schema = pa.schema([("shard", pa.int64()), ("g1", pa.binary()), ("g2", pa.binary()), ("f", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        (g1, g2, n), lengths = unpacked_rows([table[c] for c in ("g1", "g2", "n")])
        order = np.lexsort((g2, g1))      # stable: the smallest shard comes first
        a, b = g1[order], g2[order]
        start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        total = np.add.reduceat(n[order], start)
        f, keep = np.zeros(len(n), np.int64), np.zeros(len(n), bool)
        f[order[start]] = total
        keep[order] = np.repeat(total >= least, np.diff(np.append(start, len(n))))
        rows, at = [], 0
        for shard, size in zip(table["shard"].to_pylist(), lengths, strict=True):
            own = at + np.flatnonzero(keep[at:at + size])
            at += size
            if len(own):
                rows.append((shard, *packed_row([g1[own], g2[own]], f[own])))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)],
                                    schema=schema) if rows else schema.empty_table()

    return counts.groupBy("bucket").applyInArrow(run, "shard long, g1 binary, g2 binary, f binary")


GRAMS = "lang string, g1 long, g2 long, g3 long, g4 long, f1 long, f2 long, n long"


def longer_phrases(texts: DataFrame, pairs: DataFrame, buckets: int) -> DataFrame:
    """Counts in each shard of the triples and quadruples of frequent pairs, and each frequent pair
    once with its language and the frequencies of its words (in g3 and g4): (bucket, lang, g1..g4, n),
    arrays (``packed_row``) by bucket and, for pairs only, language.
    ``pairs``: the frequent pairs of every shard (``frequent_pairs``)."""
    schema = pa.schema([("bucket", pa.int64()), ("lang", pa.string()), *((c, pa.binary()) for c in ("g1", "g2", "g3", "g4", "n"))])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        code, f = unpack(left["code"][0].as_py()), unpack_long(left["f"][0].as_py())
        ids = np.cumsum(unpack_long(left["id"][0].as_py()))

        (*g, total), _ = unpacked_rows([right[c] for c in ("g1", "g2", "f")])
        g1, g2 = (np.searchsorted(ids, a) + 1 for a in g)
        once = total > 0
        width = len(ids) + 1
        frequent = np.sort(g1 * width + g2)

        def is_pair(a, b):
            key = a * width + b
            at = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
            return frequent[at] == key

        t = unpack(left["ids"][0].as_py())
        forward, reverse = Index.of(t), Index.of(t[::-1])
        a, b, lo, rlo, n = _pairs(forward, reverse)
        keep = is_pair(a, b)
        a, b, lo, rlo, n = (x[keep] for x in (a, b, lo, rlo, n))
        parent, c, rlo, lo, n = reverse.extend(rlo, lo, n)
        keep = is_pair(b[parent], c)
        a, b, c, lo, rlo, n = a[parent][keep], b[parent][keep], c[keep], lo[keep], rlo[keep], n[keep]
        above, d, _, _, m = forward.extend(lo, rlo, n)
        keep = is_pair(d, a[above])
        above, d, m = above[keep], d[keep], m[keep]
        rows = []
        g1, g2, total = g1[once], g2[once], total[once]
        code = code[g1 - 1]
        langs = left["langs"][0].as_py()
        for i in np.unique(code):
            x, y = g1[code == i] - 1, g2[code == i] - 1
            rows += ((at, langs[i], *packed_row(g, m))
                     for at, g, m in bucketed([ids[x], ids[y], f[x], f[y]], total[code == i], buckets))
        found = [np.concatenate(x) for x in zip([a, b, c], [d, a[above], b[above]], strict=True)]
        found.append(np.concatenate([np.zeros(len(a), np.int64), c[above]]))
        grams = [np.where(x > 0, ids[x - 1], 0) for x in found]
        rows += ((at, None, *packed_row(g, k)) for at, g, k in bucketed(grams, np.concatenate([n, m]), buckets))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types, strict=True)],
                                    schema=schema) if rows else schema.empty_table()

    return (texts.groupBy("shard").cogroup(pairs.withColumnRenamed("shard", "owner").groupBy("owner")).applyInArrow(
        run, "bucket long, lang string, g1 binary, g2 binary, g3 binary, g4 binary, n binary"))


def summed(phrases: DataFrame, least: int) -> DataFrame:
    """(lang, g1..g4, f1, f2, n): the pairs, and the other phrases with ``least`` occurrences in all shards."""
    names = ["lang", "g1", "g2", "g3", "g4", "f1", "f2", "n"]
    schema = pa.schema([(k, pa.string() if k == "lang" else pa.int64()) for k in names])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        (*g, n), _ = unpacked_rows([table[c] for c in ("g1", "g2", "g3", "g4", "n")])
        lang = key[1].as_py()
        if lang is None:
            order = np.lexsort(g[::-1])
            g = [a[order] for a in g]
            start = np.flatnonzero(np.concatenate([[True], np.any([a[1:] != a[:-1] for a in g], axis=0)]))
            n = np.add.reduceat(n[order], start)
            g = [a[start][n >= least] for a in g]
            n = n[n >= least]
            g += [np.zeros(len(n), np.int64)] * 2
        else:
            none = np.zeros(len(n), np.int64)
            g = [*g[:2], none, none, *g[2:]]
        return pa.Table.from_arrays([pa.array([lang] * len(n), pa.string()), *map(pa.array, [*g, n])], schema=schema)

    return phrases.groupBy("bucket", "lang").applyInArrow(run, GRAMS)


def _score(a, l, r):
    """floor(2000000 * a / (l + r)) in 38-digit integers."""
    return F.expr(
        f"(CAST({a} AS DECIMAL(19,0)) * {SCALE}) div (CAST({l} AS DECIMAL(19,0)) + CAST({r} AS DECIMAL(19,0)))")


def _lowest_cut(df: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """a, l, r and score of the lowest-scoring cut, the smallest k among equals."""
    options = F.array(*[F.struct(_score("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"),
                                 F.col(r).alias("r")) for k, (l, r) in enumerate(cuts, 1)])
    return df.withColumn("cut", F.array_min(options)).withColumns({x: F.col("cut")[x] for x in ("score", "l", "r")})


def phrase_statistics(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                      least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, names, grams): totals are (lang, n), names are (id, word) of the words with
    ``least`` occurrences; grams are (lang, g1..g4, f1, f2, a) of the phrases with ``least``
    occurrences, ids of words, 0 past the end; lang, f1 and f2 for pairs only."""
    spark = docs.sparkSession
    shard_rows, shards_at = stored(shards(docs, lang_col, text_col), "shards")
    totals = cut(shard_rows.select(F.explode("langs").alias("v")).where("v.n > 0")
                 .groupBy("v.lang").agg(F.sum("v.n").alias("n")), "totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    buckets = total // BUCKET + 1
    # a word stands in a shard once, however often it occurs
    word_buckets = total // (4 * BUCKET) + 1
    known = cut(frequent_words(word_counts(shard_rows, word_buckets), least, word_buckets), "words")
    release(spark)
    texts, texts_at = stored(frequent_shards(shard_rows, known), "texts")
    remove(spark, shards_at)

    pairs, pairs_at = stored(frequent_pairs(pair_counts(texts, buckets), least), "pairs")
    release(spark)
    # triples and quadruples together are up to two a word
    grams = cut(summed(longer_phrases(texts, pairs, 2 * buckets), least).withColumnRenamed("n", "a"), "grams")
    remove(spark, texts_at)
    remove(spark, pairs_at)
    return totals, spelt_words(known), grams


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST,
                 top: int = TOP, covered: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language."""
    totals, names, grams = phrase_statistics(docs, lang_col, text_col, least)
    two = _lowest_cut(grams.where("g3 = 0").withColumnsRenamed({"f1": "h1", "f2": "t1"}), [("h1", "t1")])
    pair = two.select("lang", "g1", "g2", "a", "h1", "t1")
    head = pair.select("lang", "g1", "g2", "h1", F.col("a").alias("h2"))
    tail = pair.select(F.col("g1").alias("g2"), F.col("g2").alias("g3"), "t1", F.col("a").alias("t2"))
    three = (grams.where("g3 > 0 AND g4 = 0").select("g1", "g2", "g3", "a")
             .join(head, ["g1", "g2"]).join(tail, ["g2", "g3"]))
    three = cut(_lowest_cut(three, [("h1", "t2"), ("h2", "t1")]), "triples")
    head = three.select("lang", "g1", "g2", "g3", "h1", "h2", F.col("a").alias("h3"))
    tail = three.select(F.col("g1").alias("g2"), F.col("g2").alias("g3"), F.col("g3").alias("g4"), "t1", "t2",
                        F.col("a").alias("t3"))
    four = (grams.where("g4 > 0").select("g1", "g2", "g3", "g4", "a")
            .join(head, ["g1", "g2", "g3"]).join(tail, ["g2", "g3", "g4"]))
    four = _lowest_cut(four, [("h1", "t3"), ("h2", "t2"), ("h3", "t1")])

    # a candidate inside a longer one is inside one that is longer by one word, and that occurs as often at least
    none = F.lit(0).cast("long")
    wider = grams.where("g3 > 0").select("g1", "g2", "g3", "g4", F.col("a").alias("b"))
    inner = wider.select("g1", "g2", F.when(F.col("g4") > 0, F.col("g3")).otherwise(none).alias("g3"), "b").unionByName(
        wider.select(F.col("g2").alias("g1"), F.col("g3").alias("g2"), F.col("g4").alias("g3"), "b"))
    inner = inner.groupBy("g1", "g2", "g3").agg(F.max("b").alias("b"))
    shape = ["lang", "g1", "g2", "g3", "g4", "a", "l", "r", "score"]
    short = two.select(*shape).unionByName(three.withColumn("g4", none).select(*shape))
    over = F.expr(f"CAST(b AS DECIMAL(19,0)) * 100 >= CAST(a AS DECIMAL(19,0)) * {int(covered)}")
    short = short.join(inner, ["g1", "g2", "g3"], "left").where(F.col("b").isNull() | ~over).select(*shape)
    kept = short.unionByName(four.select(*shape))

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    kept = kept.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place")
    # the few that are left get their words; equal scores at the end are told apart by these
    kept = cut(kept, "best")
    spelt = (kept.select("g1", "g2", "g3", "g4", F.posexplode(F.array("g1", "g2", "g3", "g4")).alias("at", "id"))
             .where("id > 0").join(names, "id")
             .groupBy("g1", "g2", "g3", "g4").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
             .select("g1", "g2", "g3", "g4", F.array_join(F.col("w.word"), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.join(spelt, ["g1", "g2", "g3", "g4"]).withColumn("rank", F.row_number().over(order).cast("long"))
            .where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def collocations_sql(least: int = LEAST, top: int = TOP, covered: int = COVERED) -> str:
    """The same rows in DuckDB SQL."""
    return rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, w[i : i + k - 1] AS g, count(*) AS f
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE len(g) = 1 GROUP BY lang),
candidates AS (SELECT lang, g, f AS a FROM grams WHERE len(g) > 1 AND f >= {least}),
cuts AS (
  SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r,
         2000000 * c.a::HUGEINT // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM candidates) c
  JOIN grams x ON x.lang = c.lang AND x.g = c.g[1 : k] JOIN grams y ON y.lang = c.lang AND y.g = c.g[k + 1 :]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT DISTINCT lang, g[i : i + m - 1] AS g, a AS b FROM (
    SELECT lang, g, a, m, unnest(range(1, len(g) - m + 2)) AS i FROM (
      SELECT lang, g, a, unnest(range(2, len(g))) AS m FROM candidates))),
kept AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM lowest
  WHERE NOT EXISTS (SELECT 1 FROM inner_parts p WHERE p.lang = lowest.lang AND p.g = lowest.g
                    AND 100 * p.b::HUGEINT >= {covered} * lowest.a::HUGEINT))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= {top}
"""
