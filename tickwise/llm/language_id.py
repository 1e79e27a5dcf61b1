"""Language of a document by mixture inference over character n-grams.

Training counts hashed character trigrams for each language over all labelled
rows (map-side sums, one shuffle of at most ``BUCKETS`` rows per language and
task).  A document is a mixture: expectation-maximisation finds the language
proportions that maximise the likelihood of its trigrams, and of the nested
sets of its largest languages the one with the best penalised likelihood is
its language set.  The prediction is the largest member; the score is its
proportion in the full mixture.

The model has ``BUCKETS`` numbers a language and at most ``MAX_LANGS``
languages, which bounds what is broadcast; more languages raise an error.
Null texts and texts without a letter give ``und`` with score 0, and so do all
texts when nothing was learned; ties go to the alphabetically first language;
rows without a language are not learned from; texts of any length are read
whole, in blocks.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_batches

BUCKETS = 1 << 15
MAX_LANGS = 512
BLOCK = 1 << 20
SMOOTHING = 0.5
ROUNDS = 40
PENALTY = 2.0      # times log(n)/2 for each further language
SMALLEST = 0.02    # share below which a language isn't considered further


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed lower-case trigrams of letters, runs of anything else
    being one space; None without a letter."""
    if not text:
        return None
    letters, out, any_letter = _letters(), np.zeros(BUCKETS, np.int64), False
    for at in range(0, len(text), BLOCK):
        # two characters of overlap carry the trigrams across block edges
        part = text[max(0, at - 2):at + BLOCK].lower()
        c = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters[c]
        if not is_letter.any():
            continue
        any_letter = True
        c = np.where(is_letter, c, 32)
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
        c = c[keep].astype(np.uint64)
        h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
             ^ c[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
        out += np.bincount((h >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return out if any_letter else None


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and their trigram probabilities (one row each)."""
    ship_package(docs.sparkSession)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                c = gram_counts(text.as_py())
                if c is not None:
                    if lang not in sums and len(sums) >= MAX_LANGS:
                        raise ValueError(f"more than {MAX_LANGS} languages")
                    sums[lang] = sums[lang] + c if lang in sums else c
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at])],
                names=["lang", "bucket", "n"])

    labelled = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sums = (labelled.mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    got = sums.toArrow()    # at most BUCKETS x MAX_LANGS rows of three numbers
    langs = sorted(set(got.column("lang").to_pylist()))
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    counts = np.zeros((len(langs), BUCKETS))
    row = {lang: i for i, lang in enumerate(langs)}
    counts[[row[x] for x in got.column("lang").to_pylist()], got.column("bucket").to_numpy()] = \
        got.column("n").to_numpy()
    p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return langs, p.astype(np.float32)


def mixture(p: np.ndarray, c: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """EM: proportions of the rows of ``p`` in the counts ``c``, and the log-likelihood."""
    k, n = len(p), c.sum()
    theta = np.full(k, 1 / k) if start is None else start / start.sum()
    for _ in range(ROUNDS if k > 1 else 0):
        new = theta * (p @ (c / (theta @ p))) / n
        done = np.abs(new - theta).max() < 1e-3
        theta = new
        if done:
            break
    return theta, float(c @ np.log(theta @ p))


def infer(p: np.ndarray, counts: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Language set by penalised likelihood (largest first), and the full mixture."""
    at = np.flatnonzero(counts)
    # neighbouring trigrams share characters: a third of the counts is independent
    c, q = counts[at] / 3.0, p[:, at].astype(np.float64)
    theta, _ = mixture(q, c)
    order = np.argsort(-theta, kind="stable")
    best, chosen = -np.inf, order[:1]
    for k in range(1, len(order) + 1):
        if k > 1 and theta[order[k - 1]] < SMALLEST:
            break
        rows = order[:k]
        _, fit = mixture(q[rows], c, theta[rows])
        fit -= PENALTY * (k - 1) * np.log(max(2.0, c.sum())) / 2
        if fit > best:
            best, chosen = fit, rows
    return [int(i) for i in chosen], theta


def predict(docs: DataFrame, langs: list[str], p: np.ndarray, id_col: str = "doc_id",
            text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, ``extra`` columns, prediction, score, and the language set."""
    model = docs.sparkSession.sparkContext.broadcast((langs, p))
    width = 1 + len(extra)

    def make():
        names, probs = model.value

        def one(text):
            counts = gram_counts(text) if names else None
            if counts is None or not counts.any():
                return "und", 0.0, []
            chosen, theta = infer(probs, counts)
            return names[chosen[0]], float(min(1.0, theta[chosen[0]])), [names[i] for i in chosen]

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            got = [one(t.as_py()) for t in b.column(width)]
            return pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(width)), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.list_(pa.string()))],
                names=[id_col, *extra, "lang_pred", "score", "langs"])
        return step

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in (id_col, *extra))
    return map_batches(docs.select(id_col, *extra, text_col), make,
                       f"{kinds}lang_pred string, score double, langs array<string>")


def held_out(id_col: str = "doc_id"):
    """True for the rows kept from training; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
