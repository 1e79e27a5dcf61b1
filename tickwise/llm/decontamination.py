"""Benchmark decontamination: BM25 over test items with block-max WAND.

The test items are the indexed side.  Each posting holds a normalised BM25
impact (an item scored by its own words has 1), items lie in blocks, and every
term keeps its largest impact per block.  Every passage of a training text - a
window of twice the longest item's words, stepping by half of it, so that an
item that occurs lies whole in some window - is a query of its distinct words.
The sums of block maxima rule out blocks whose bound stays under the threshold;
in the others the posting lists are walked with WAND pivots, and every item
scoring at least the threshold is retrieved, without a top-k cut.  A retrieved
item counts when 0.8 of its five-word shingles lie in the passage and both its
question part and its answer part overlap it.

Document frequencies, the number of items and their mean length are counted
once over all items, so a score doesn't depend on how items are grouped.  The
index is built by Spark in shards of bounded items and bytes (by length class)
and stored in the shared folder.  The texts are read once per group of shards
that fits the broadcast bound; with several groups, each pass is written before
the next group is loaded, so one group at a time is held.

Words are runs of letters, digits or underscores in lower case.  Null texts are
empty; items without a word match nothing; items shorter than a shingle use
their whole length as one; repeated items and documents give repeated rows.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import cut

THRESHOLD = 0.5        # share of an item's own BM25 score
SHINGLE = 5
OVERLAP = 0.8
PART_OVERLAP = 0.5     # of the distinct words of the question and of the answer
BLOCKS = 64            # blocks per shard
SHARD_ITEMS = 2048
SHARD_BYTES = 4 << 20
PASS_BYTES = 32 << 20  # text bytes of the shards that are broadcast together
TEXT_BLOCK = 1 << 20
K1, B = 1.2, 0.75
words_of = re.compile(r"\w+").findall


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence or line answers what is before it."""
    parts = [p for p in re.split(r"(?<=[.?!])\s+|\n", text) if p.strip()]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, text)


def shingles(words: list[str], k: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(k)), strict=False)) if words else set()


@dataclass
class Index:
    """One shard; plain data, built by one task from a bounded set of items."""

    ids: list
    terms: dict[str, int]             # word -> row of ``bound``; 0 is no term
    bound: np.ndarray                 # term x block: largest impact
    postings: list[list[list[tuple[int, float]]]]   # term -> block -> (item, impact), items ascending
    shingle: list[tuple[int, set]]
    parts: list[tuple[set, set]]
    span: int                         # words of the longest item

    @classmethod
    def build(cls, items: list[tuple[object, str]], df: dict[str, int] | None = None, n_items: int | None = None,
              mean: float | None = None) -> Index:
        """The statistics are those of all items; without them, of these alone."""
        words = [words_of(t.lower()) for _, t in items]
        tf = [Counter(w) for w in words]
        if df is None:
            df, n_items = Counter(t for c in tf for t in c), len(items)
            mean = sum(map(len, words)) / max(1, len(words))
        mean = max(1.0, mean)
        idf = {t: math.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) for c in tf for t in c}
        terms = {t: i + 1 for i, t in enumerate(sorted(idf))}
        width = max(1, -(-len(items) // BLOCKS))
        blocks = max(1, -(-len(items) // width))
        bound = np.zeros((len(terms) + 1, blocks), np.float32)
        postings = [[[] for _ in range(blocks)] for _ in range(len(terms) + 1)]
        for d, c in enumerate(tf):
            norm = K1 * (1 - B + B * len(words[d]) / mean)
            raw = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in c.items()}
            own = sum(raw.values()) or 1.0
            for t, x in raw.items():
                i, b = terms[t], d // width
                postings[i][b].append((d, x / own))
                bound[i, b] = max(bound[i, b], x / own)
        parts = [tuple(set(words_of(p.lower())) for p in split_item(t)) for _, t in items]
        grams = [(k := min(SHINGLE, len(w)), shingles(w, k) if w else set()) for w in words]
        return cls([i for i, _ in items], terms, bound, postings, grams, parts, max(map(len, words), default=0))

    def walk(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """WAND over one block: items whose score reaches the threshold."""
        lists = [(self.postings[t][block], float(self.bound[t, block])) for t in terms if self.postings[t][block]]
        at, found = [0] * len(lists), []
        while True:
            live = sorted((lists[i][0][at[i]][0], i) for i in range(len(lists)) if at[i] < len(lists[i][0]))
            total, pivot = 0.0, None
            for d, i in live:
                total += lists[i][1]
                if total >= threshold - 1e-6:
                    pivot = d
                    break
            if pivot is None:
                return found
            if live[0][0] == pivot:
                score = 0.0
                for d, i in live:
                    if d != pivot:
                        break
                    score += lists[i][0][at[i]][1]
                    at[i] += 1
                if score >= threshold - 1e-6:
                    found.append((pivot, score))
            else:   # lists before the pivot skip up to it
                for d, i in live:
                    if d >= pivot:
                        break
                    posts = lists[i][0]
                    while at[i] < len(posts) and posts[at[i]][0] < pivot:
                        at[i] += 1

    def search(self, text: str, threshold: float = THRESHOLD) -> dict[int, tuple[float, float, float, float]]:
        """Verified items of a text -> (score, item, question and answer overlap), best passage."""
        best: dict[int, tuple[float, float, float, float]] = {}
        if not self.span:
            return best
        step, get = self.span, self.terms.get
        for words in _pieces(text, step):
            rows = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
            at = np.flatnonzero(rows)
            if not len(at):
                continue
            n = len(self.terms) + 1
            chunk = at // step   # window k holds chunks k and k + 1
            key = np.unique(np.concatenate([chunk * n + rows[at], (chunk[chunk > 0] - 1) * n + rows[at[chunk > 0]]]))
            window, term = key // n, key % n
            first = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
            bounds = np.add.reduceat(self.bound[term], first, axis=0)
            ends = np.r_[first[1:], len(key)]
            for k, block in np.argwhere(bounds >= threshold - 1e-5):
                w = int(window[first[k]])
                for item, score in self.walk(term[first[k]:ends[k]].tolist(), int(block), threshold):
                    seen = words[w * step:(w + 2) * step]
                    got = self._verify(item, seen)
                    if got and (score, *got) > best.get(item, (0,)):
                        best[item] = (score, *got)
        return best

    def _verify(self, item: int, seen: list[str]) -> tuple[float, float, float] | None:
        k, grams = self.shingle[item]
        if not grams:
            return None
        whole = len(grams & shingles(seen, k)) / len(grams)
        if whole < OVERLAP:
            return None
        have = set(seen)
        question, answer = (len(p & have) / len(p) if p else 1.0 for p in self.parts[item])
        return (whole, question, answer) if min(question, answer) >= PART_OVERLAP else None


def _pieces(text: str, step: int):
    """Word lists of bounded text blocks; the next one repeats the last window."""
    text, keep, at = text.lower(), [], 0
    while at < len(text):
        end = min(len(text), at + TEXT_BLOCK)
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        words = keep + words_of(text[at:end])
        yield words
        keep, at = words[-2 * step:], end


def _terms(shard_items: DataFrame) -> DataFrame:
    """(shard, term, n, length): in how many items of a shard a term stands, and, for a null term,
    the items of the shard and their words."""
    def run(batches):
        for b in batches:
            n, items, length = Counter(), Counter(), Counter()
            for shard, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = words_of(text.lower())
                n.update((shard, w) for w in set(words))
                items[shard] += 1
                length[shard] += len(words)
            rows = [(s, w, c, 0) for (s, w), c in n.items()] + [(s, None, c, length[s]) for s, c in items.items()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["shard", "term", "n", "length"])

    return (shard_items.select("shard", "text").mapInArrow(run, "shard string, term string, n long, length long")
            .groupBy("shard", "term").agg(F.sum("n").alias("n"), F.sum("length").alias("length")))


def stored_indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame | None:
    """(shard, bytes, index) of all items, one row a shard of bounded size; None without items."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = items.select(F.col(id_col).alias("id"), text.alias("text"), F.floor(F.log2(
        F.greatest(F.size(F.split(text, r"\W+")), F.lit(32)))).alias("size"))
    classes = sized.groupBy("size").agg(F.count("*"), F.sum(F.octet_length("text"))).collect()
    if not classes:
        return None
    # a few dozen length classes at most
    shards = F.create_map(*[F.lit(x) for size, n, n_bytes in classes
                            for x in (size, max(-(-n // SHARD_ITEMS), -(-n_bytes // SHARD_BYTES)))])
    shard = F.concat_ws("-", F.col("size"), F.pmod(F.xxhash64("id", "text"), shards[F.col("size")]))
    sized = cut(sized.select(shard.alias("shard"), "id", "text"), "items")
    terms = cut(_terms(sized), "terms")
    n_items, words = terms.where("term IS NULL").agg(F.sum("n"), F.sum("length")).first()
    mean = words / n_items
    df = terms.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"))
    needed = terms.where("term IS NOT NULL").select("shard", "term").join(df, "term").withColumnRenamed("shard", "owner")

    def build(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by([("id", "ascending"), ("text", "ascending")])
        found = dict(zip(right["term"].to_pylist(), right["df"].to_pylist(), strict=True))
        texts = left["text"].to_pylist()
        index = Index.build(list(zip(left["id"].to_pylist(), texts, strict=True)), found, n_items, mean)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.string()),
                         "bytes": pa.array([sum(len(t.encode()) for t in texts)], pa.int64()),
                         "index": pa.array([pickle.dumps(index)], pa.binary())})

    return cut(sized.groupBy("shard").cogroup(needed.groupBy("owner")).applyInArrow(
        build, "shard string, bytes long, index binary"), "indexes")


def passes(indexes: DataFrame):
    """Groups of shard indexes that may be held together, each loaded when it is asked for; whether
    more follow."""
    sizes = [tuple(r) for r in indexes.select("shard", "bytes").orderBy("shard").collect()]   # two numbers a shard
    groups, held = [[]], 0
    for shard, n in sizes:
        if groups[-1] and held + n > PASS_BYTES:
            groups.append([])
            held = 0
        groups[-1].append(shard)
        held += n
    for i, names in enumerate(groups):
        rows = indexes.where(F.col("shard").isin(names)).orderBy("shard").select("index").collect()
        yield [pickle.loads(r[0]) for r in rows], i + 1 < len(groups)


def contaminated_pairs(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document row, item) found: ids, score and the overlaps."""
    spark = docs.sparkSession
    ship_package(spark)
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = (f"`{id_col}` {kinds[0]}, `{item_id}` {kinds[1]}, score double, item_overlap double, "
              "question_overlap double, answer_overlap double")
    source, out = docs.select(id_col, text_col), None
    item_type = pa.schema(items.select(item_id).limit(0).toArrow().schema).field(0).type
    indexes = stored_indexes(items, item_id, item_text)
    for group, more in passes(indexes) if indexes is not None else ():
        shared = spark.sparkContext.broadcast(group)

        def run(batches, shared=shared):
            indexes = shared.value
            for b in batches:
                at, found = [], []
                for i, t in enumerate(b.column(1)):
                    for ix in indexes:
                        for item, got in sorted(ix.search(t.as_py() or "", threshold).items()):
                            at.append(i)
                            found.append((ix.ids[item], *got))
                cols = list(zip(*found, strict=True)) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at, pa.int64())), pa.array(cols[0], item_type),
                     *(pa.array(c, pa.float64()) for c in cols[1:])],
                    names=[id_col, item_id, "score", "item_overlap", "question_overlap", "answer_overlap"])

        part = source.mapInArrow(run, schema)
        if more:
            part = cut(part, "found")
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The input rows in which no item was found, all columns as they were."""
    spark = docs.sparkSession
    ship_package(spark)
    place = docs.columns.index(text_col)
    indexes = stored_indexes(items, item_id, item_text)
    for group, more in passes(indexes) if indexes is not None else ():
        shared = spark.sparkContext.broadcast(group)

        def run(batches, shared=shared):
            indexes = shared.value
            for b in batches:
                clean = [not any(ix.search(t.as_py() or "", threshold) for ix in indexes) for t in b.column(place)]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if more:
            docs = cut(docs, "clean")
            shared.destroy()
    return docs
