"""Texts as shards of numbered words, shared by the operators that count n-grams.

A shard is a run of rows of one task: its words are numbered by first
appearance in the shard, so a shard is an array of small integers and a list of
its words.  Shards have a fixed number of words (a row is never split over
two, but a text is numbered in blocks), which bounds what one task holds.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

#: Words of a shard; memory of a task that works on one is about 100 bytes a word.
SHARD_WORDS = 1 << 21


def pack(a: np.ndarray) -> bytes:
    """Non-negative integers as compressed 32-bit numbers, one plane a byte, after their count."""
    planes = a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(a).to_bytes(8, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.Codec("zstd").decompress(b[8:], 4 * n, asbytes=True), np.uint8)
    return planes.reshape(4, n).T.copy().view("<u4").ravel().astype(np.int64)


def shard_names():
    """Numbers of shards, unique over the tasks of a stage."""
    first = TaskContext.get().partitionId() << 24
    return (first + i for i in count())


class Numbering:
    """Numbers from 1 for the (key, word) pairs of a shard, in order of appearance."""

    def __init__(self):
        self._next = count(1).__next__
        self._of = defaultdict(lambda: defaultdict(self._next))

    def of(self, key, words: list) -> np.ndarray:
        return np.fromiter(map(self._of[key].__getitem__, words), np.int64, len(words))

    def pairs(self) -> list[tuple]:
        """(key, word) by number."""
        out = [(i, key, w) for key, words in self._of.items() for w, i in words.items()]
        out.sort()
        return [p[1:] for p in out]
