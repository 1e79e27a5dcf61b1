"""Toxicity of texts by two Kneser-Ney language models, one a class.

Both classes count words and word pairs over all labelled documents, each once a
document, so that a text that repeats itself weighs no more; a pair's probability
is its discounted count plus the class's backoff weight times the class's
continuation probability (in how many distinct contexts a word stands),
and that is smoothed by continuation counts which both classes share.  The
difference of the two log-likelihoods of a text, divided by its number of
words, and the part of that difference that comes from strongly one-sided words
go through a logistic curve, fitted on a bounded sample of the labelled rows.

An expression is rare if toxic documents have it fewer than ``LEAST`` times and
fewer would be expected of them.  Rare words are one word to the models, and rare
pairs back off in both; all others have numbers of their own, however large the
corpus is.  Words are broadcast.  So are the pairs that make up ``RARE`` of
either class, at most 2 / ``RARE``; all further ones stay a table, which is
joined to the pairs of the texts, so that scores don't depend on ``RARE``.  A
bit map of fixed size tells which pairs of a text may be in that table.  The
counts behind the models take in every labelled row.

Words are runs of letters, digits and non-ASCII characters in lower case, known
by 64 bits of XXH64; two words of one hash would count as one.  A document
whose labels differ, or whose id is null, is not learned from; labels other
than 0 and 1 are ignored.  A null text is empty; an empty text gets the curve's
value for no evidence.  If a class has no words to learn from, every score is
the smoothed share of toxic labels.  Texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import cut, remove, stored

LEAST = 3
RARE = 1e-6             # share of a class's pairs below which a pair is joined, not broadcast
MARKS = 27              # places of the bit map, as a power of two
DISCOUNT = 0.75
SAMPLE = 20_000         # labelled rows the curve is fitted on
ASIDE = 4               # one text of so many is set aside for the curve
THRESHOLD = 0.7
STRONG, MOST = 3.0, 0.05    # a one-sided pair's excess starts at STRONG; a mean excess over MOST says no more
BLOCK = 1 << 22         # characters of a text that are split at once
GROUP = 1 << 20         # words that are worked on at once
UNKNOWN, START, FIRST = 0, 1, 2

_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


class Hashes(dict):
    """Words' hashes, each distinct word hashed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word) >> 1
        return h

    def of(self, text: str | None) -> np.ndarray:
        parts, at, text = [], 0, text or ""
        while at < len(text):
            end = text.find(" ", at + BLOCK)
            end = len(text) if end < 0 else end
            words = text[at:end].lower().encode().translate(_WORD_BYTES).split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def groups(batches, width: int):
    """Rows of the batches in groups of about ``GROUP`` words: (batch slices, hashes, words of each row).
    The text is the last of ``width`` columns."""
    hashes = Hashes()
    for b in batches:
        first, found, size = 0, [], 0
        for i, text in enumerate(b.column(width - 1)):
            found.append(hashes.of(text.as_py()))
            size += len(found[-1])
            if size >= GROUP or i + 1 == b.num_rows:
                yield b.slice(first, i + 1 - first), np.concatenate(found), np.array([len(a) for a in found])
                first, found, size = i + 1, [], 0


def once(keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of each text: (text, distinct keys of all, place among these)."""
    distinct, at = np.unique(keys, return_inverse=True)
    both = np.unique(np.repeat(np.arange(len(lengths)), lengths) * max(len(distinct), 1) + at)
    row, at = np.divmod(both, max(len(distinct), 1))
    return row, distinct, at


@dataclass
class Words:
    """Sorted hashes of the words that have numbers of their own."""
    hashes: np.ndarray

    def numbers(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), UNKNOWN)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at + FIRST, UNKNOWN)

    @property
    def width(self) -> int:
        return len(self.hashes) + FIRST

    def pairs(self, h: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(context, word) numbers of all words; a text's first word follows ``START``."""
        w = self.numbers(h)
        before = np.concatenate([[START], w[:-1]])[: len(w)]
        starts = np.cumsum(lengths) - lengths
        before[starts[lengths > 0]] = START
        return before, w


@dataclass
class Model:
    """log p(toxic) - log p(ordinary) of a pair is context + word, plus what the pair itself adds."""
    words: Words
    of_context: np.ndarray
    of_word: np.ndarray
    pair_keys: np.ndarray
    of_pair: np.ndarray
    curve: np.ndarray | None = None      # weights and constant
    share: float = 0.0                   # of toxic labels
    more: DataFrame | None = None        # what further pairs add: (key, adds, excess)
    marks: np.ndarray | None = None      # bit map of their keys

    def alone(self) -> Model:
        """What tasks get."""
        return replace(self, more=None)

    def sums(self, h: np.ndarray, lengths: np.ndarray):
        """Per text, over its distinct pairs: their number, the sum of log ratios and the excess of strong ones
        by the broadcast pairs; then text and key of the pairs that ``more`` may have."""
        before, w = self.words.pairs(h, lengths)
        row, keys, at = once(before * self.words.width + w, lengths)
        before, w = np.divmod(keys, self.words.width)
        r = self.of_context[before] + self.of_word[w]
        if len(self.pair_keys):
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            known = self.pair_keys[place] == keys
            r += np.where(known, self.of_pair[place], 0.0)
        else:
            known = np.zeros(len(keys), bool)
        open_ = at[:0]
        if self.marks is not None:
            cell, bit = _places(keys, len(self.marks))
            open_ = np.flatnonzero((~known & (self.marks[cell] & bit != 0))[at])
        n = np.maximum(np.bincount(row, minlength=len(lengths)), 1)
        total, excess = (np.bincount(row, v[at], len(lengths)).astype(float) for v in (r, np.maximum(r - STRONG, 0)))
        return n, total, excess, row[open_], keys[at[open_]]

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(features), self.share)
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[:-1] + self.curve[-1], -500, 500)))


def _features_of(n: np.ndarray, total: np.ndarray, excess: np.ndarray) -> np.ndarray:
    """Per text, over its distinct pairs: the mean log ratio, and the mean excess of strong ones."""
    return np.stack([total / n, np.minimum(excess / n, MOST)], axis=1)


def _places(keys: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell and bit of keys in a bit map of so many cells, a power of two."""
    at = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(59 - cells.bit_length())
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _class_counts(batches, key_of):
    """Batches of (key columns, toxic count, ordinary count) of what ``key_of`` finds in each group."""
    for b, h, lengths in groups(batches, 2):
        key, names, split = key_of(h, lengths)
        row, keys, at = once(key, lengths)
        toxic = np.asarray(b.column(0))[row] == 1
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, split(keys)), pa.array(np.bincount(at[toxic], minlength=len(keys))),
             pa.array(np.bincount(at[~toxic], minlength=len(keys)))], names=[*names, "t", "o"])


def _frequent(n_toxic: int, n_all: int):
    """Whether toxic count t and ordinary count o are those of an expression that isn't rare."""
    return (F.col("t") >= LEAST) | (F.col("t") + F.col("o") >= LEAST / (n_toxic / n_all))


def _common(n_toxic: int, n_all: int):
    """Whether they are those of a pair that is broadcast."""
    return (F.col("t") >= RARE * n_toxic) | (F.col("t") + F.col("o") >= RARE * n_all)


def _marks(more: DataFrame) -> np.ndarray:
    """The bit map of the keys, of one size however many they are."""
    cells = 1 << MARKS >> 6

    def run(batches):
        for b in batches:
            cell, bit = _places(np.asarray(b.column(0)), cells)
            order = np.argsort(cell, kind="stable")
            cell, first = np.unique(cell[order], return_index=True)
            if len(cell):
                bits = np.bitwise_or.reduceat(bit[order], first)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bits.view(np.int64))], names=["cell", "bits"])

    got = (more.select("key").mapInArrow(run, "cell long, bits long").groupBy("cell")
           .agg(F.bit_or("bits").alias("bits")).toArrow())
    marks = np.zeros(cells, np.uint64)
    marks[np.asarray(got.column("cell"))] = np.asarray(got.column("bits")).view(np.uint64)
    return marks


def _log_ratio(t: np.ndarray, o: np.ndarray) -> np.ndarray:
    return np.log(t) - np.log(o)


def language_models(labelled: DataFrame) -> Model | None:
    """Both models from (toxic int, text) rows; None if a class has no words."""
    spark = labelled.sparkSession

    def words(batches):
        return _class_counts(batches, lambda h, _: (h, ["h"], lambda k: [k]))

    counts, counts_at = stored(labelled.mapInArrow(words, "h long, t long, o long").groupBy("h")
                               .agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "words")
    n = counts.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    if not n.t or not n.o:
        remove(spark, counts_at)
        return None
    frequent = _frequent(n.t, n.t + n.o)
    vocabulary = Words(np.sort(np.asarray(counts.where(frequent).select("h").toArrow().column(0))))
    remove(spark, counts_at)
    width, shared = vocabulary.width, spark.sparkContext.broadcast(vocabulary)

    def pairs(batches):
        def key_of(h, lengths):
            before, w = shared.value.pairs(h, lengths)
            return before * width + w, ["b", "w"], lambda k: np.divmod(k, width)
        return _class_counts(batches, key_of)

    found, found_at = stored(labelled.mapInArrow(pairs, "b long, w long, t long, o long").groupBy("b", "w")
                             .agg(F.sum("t").alias("t"), F.sum("o").alias("o")).withColumn("kept", frequent), "pairs")

    def off(c):
        return F.sum(F.when(F.col("kept") & (F.col(c) > 0), F.col(c) - DISCOUNT).otherwise(0.0)).alias(f"off_{c}")

    # one row a word of the vocabulary
    contexts = found.groupBy("b").agg(F.sum("t").alias("t"), F.sum("o").alias("o"), off("t"), off("o")).toArrow()
    places = found.groupBy("w").agg(F.count_if(F.col("t") > 0).alias("t"), F.count_if(F.col("o") > 0).alias("o"),
                                    F.count("*").alias("both")).toArrow()
    def column(table, key, name):
        out = np.zeros(width)
        out[np.asarray(table.column(key))] = np.asarray(table.column(name))
        return out

    both = column(places, "w", "both") + 0.5
    both /= both.sum()
    word, weight = {}, {}
    for c in ("t", "o"):
        seen = column(places, "w", c)
        kept_mass = np.maximum(seen - DISCOUNT, 0)
        word[c] = (kept_mass + (seen.sum() - kept_mass.sum()) * both) / seen.sum()
        total = column(contexts, "b", c)
        weight[c] = np.where(total > 0, (total - column(contexts, "b", f"off_{c}")) / np.maximum(total, 1), 1.0)
    of_context, of_word = _log_ratio(weight["t"], weight["o"]), _log_ratio(word["t"], word["o"])
    totals = {c: column(contexts, "b", c) for c in ("t", "o")}
    shared = spark.sparkContext.broadcast((totals, weight, word, of_context, of_word))

    def rate(batches):
        totals, weight, word, of_context, of_word = shared.value
        for batch in batches:
            b, w = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            p = {}
            for i, c in enumerate(("t", "o"), 2):
                own = np.maximum(np.asarray(batch.column(i)) - DISCOUNT, 0) / np.maximum(totals[c][b], 1)
                p[c] = own + weight[c][b] * word[c][w]
            base = of_context[b] + of_word[w]
            adds = _log_ratio(p["t"], p["o"]) - of_context[b] - of_word[w]
            excess = np.maximum(base + adds - STRONG, 0) - np.maximum(base - STRONG, 0)
            yield pa.RecordBatch.from_arrays([pa.array(b * width + w), pa.array(adds), pa.array(excess), batch.column(4)],
                                             names=["key", "adds", "excess", "common"])

    rated, rated_at = stored(found.where("kept").select("b", "w", "t", "o", _common(n.t, n.t + n.o).alias("common"))
                             .mapInArrow(rate, "key long, adds double, excess double, common boolean"), "rated")
    remove(spark, found_at)
    common = rated.where("common").select("key", "adds").toArrow()
    key = np.asarray(common.column("key"))
    order = np.argsort(key)
    model = Model(vocabulary, of_context, of_word, key[order], np.asarray(common.column("adds"))[order])
    more = rated.where("NOT common").drop("common")
    if more.isEmpty():
        remove(spark, rated_at)
    else:
        model.more, model.marks = more, _marks(more)
    return model


def _rated(docs: DataFrame, model: Model, kept: str, finish, schema: str) -> DataFrame:
    """The columns before the text, which is the last one, and what ``finish`` makes of the features."""
    spark, width = docs.sparkSession, len(docs.columns)
    shared, names = spark.sparkContext.broadcast(model.alone()), docs.columns[:-1]
    added = [c.split()[0] for c in schema.split(", ")]

    def batch(columns, *sums):
        return pa.RecordBatch.from_arrays([*columns, *map(pa.array, finish(shared.value, _features_of(*sums)))],
                                          names=[*names, *added])

    if model.more is None:
        def run(batches):
            for b, h, lengths in groups(batches, width):
                yield batch(b.columns[:-1], *shared.value.sums(h, lengths)[:3])

        return docs.mapInArrow(run, kept + schema)

    own = ["_row", "_n", "_total", "_excess", "_keys"]

    def open_pairs(batches):
        number = count(TaskContext.get().partitionId() << 33)
        for b, h, lengths in groups(batches, width):
            n, total, excess, row, keys = shared.value.sums(h, lengths)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n)))]).astype(np.int32)
            rows = np.fromiter((next(number) for _ in n), np.int64, len(n))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(rows), pa.array(n), pa.array(total), pa.array(excess),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))], names=[*names, *own])

    # written once, so that both readers see the same row numbers
    rows = cut(docs.mapInArrow(open_pairs, kept + "_row long, _n long, _total double, _excess double, _keys array<long>"),
               "texts")
    found = (rows.select("_row", F.explode("_keys").alias("key")).join(model.more.hint("merge"), "key")
             .groupBy("_row").agg(F.sum("adds").alias("_adds"), F.sum("excess").alias("_more")))
    added_up = rows.drop("_keys").join(found.hint("merge"), "_row", "left").select(
        *names, "_n", *((F.col(a) + F.coalesce(F.col(b), F.lit(0.0))).alias(a) for a, b in (("_total", "_adds"), ("_excess", "_more"))))

    def end(batches):
        for b in batches:
            yield batch(b.columns[:-3], *map(np.asarray, b.columns[-3:]))

    return added_up.mapInArrow(end, kept + schema)


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, on features of unit spread."""
    spread = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([x / spread, np.ones(len(x))])
    beta = np.zeros(z.shape[1])
    pull = np.diag([ridge] * x.shape[1] + [1e-6]) * len(x) / 100
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + pull, z.T @ (y - p) - pull @ beta)
        beta += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return np.append(beta[:-1] / spread, beta[-1])


def _features(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``SAMPLE`` rows."""
    got = _rated(sample, model, "toxic int, ", lambda _, f: f.T.copy(), "mean double, strong double").toArrow()
    return np.stack([np.asarray(got.column(c)) for c in ("mean", "strong")], axis=1), np.asarray(got.column("toxic")).astype(float)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """The models and the curve from all rows of ``docs`` that ``labels`` marks 0 or 1."""
    spark = docs.sparkSession
    ship_package(spark)
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
             .where("toxic IN (0, 1)").groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
             .where("toxic = most").drop("most"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    # both sides grow with the corpus: never a broadcast
    labelled, at = stored(rows.join(marks.hint("merge"), "id").select("id", "toxic", "text"), "labelled")
    n = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}      # two rows at most
    share = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1)
    texts = labelled.select("toxic", "text")
    model = language_models(texts)
    if model is None:
        model = Model(Words(np.zeros(0, np.int64)), np.zeros(FIRST), np.zeros(FIRST), np.zeros(0, np.int64),
                      np.zeros(0), share=share)
    else:
        # models see their own documents too well: the curve comes from texts that its models don't know
        place = F.xxhash64("text")
        aside = F.pmod(place, F.lit(ASIDE)) == 0
        rest = language_models(texts.where(~aside))
        x, y = _features(texts.where(aside).orderBy(place).limit(SAMPLE), rest or model)
        if rest is None or len(np.unique(y)) < 2:
            x, y = _features(texts.orderBy(place).limit(SAMPLE), model)
        model.curve, model.share = _fit_curve(x, y), share
    remove(spark, at)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, ``extra`` columns, score, predicted, and the length-normalised
    difference of the log-likelihoods."""
    ship_package(docs.sparkSession)

    def finish(model, f):
        s = model.scores(f)
        return s, (s >= THRESHOLD).astype(np.int32), f[:, 0].copy()

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in (id_col, *extra))
    return _rated(docs.select(id_col, *extra, text_col), model, kinds, finish,
                  "score double, predicted int, ratio double")


def held_out(id_col: str = "doc_id"):
    """True for the rows kept from training; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
