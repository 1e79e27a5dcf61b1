"""Document quality rules: a threshold table compiled into one projection.

Every measure is a native expression over the text; ``compile_rules`` turns the
table into a single conjunction.  Nothing is shuffled and no Python runs.

Words are runs of anything but space and \\t\\n\\v\\f\\r.  A null or empty text has no
words and fails the base rule; ties and repeated rows are judged one by one;
texts are measured whole.  Ratios are taken per word (0 without words).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Frequent function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = """a an and are as at be by for from had has have he in is it not of on or she that the they this to
    was were which with als auch auf aus bei das dem den der des die ein eine einen er es für im ist mit nicht
    sich sie und von zu zum au aux avec ce dans de du elle en est et il la le les ne par pas pour qui que se sur un
    une al como con del el las lo los más no para por su una y
    che della di gli non per sono un da dos em não os uma het een niet van dat te""".split()
#: Words are compared in small letters and without marks around them, by tables, so that no
#: engine's own case folding matters.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÁÃÉÜ", "abcdefghijklmnopqrstuvwxyzáãéü"
MARKS = """.,;:!?"'()[]{}<>*_-…“”„‘’«»¿¡"""


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; None leaves a side open."""

    measure: str
    low: float | None
    high: float | None


#: Verdict of the method for documents that pass the base rule.
RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("marks_per_word", None, 0.1),
    Rule("stop_word_share", 0.05, None),
    Rule("dup_line_share", None, 0.5),
)


def _count(text: Column, chars: str) -> Column:
    """Characters of the class ``chars`` (a regex class without brackets)."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more: windows are sorted
    with their places, equal neighbours mark repeated places, and the sorted
    places are added up with overlaps counted once."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")))
    last = n - 3   # index of the last window

    def repeated(s: Column) -> Column:
        here = F.transform(s, lambda x, k: F.when(
            ((k > 0) & (F.get(s, k - 1)["w"] == x["w"])) | ((k < last) & (F.get(s, k + 1)["w"] == x["w"])), x["i"]))
        return F.sort_array(F.filter(here, lambda p: p.isNotNull()))

    def covered(places: Column) -> Column:
        step = F.transform(places, lambda p, k: F.least(
            F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    return F.when(n >= 3, _let(_let(F.sort_array(windows), repeated), covered)).otherwise(F.lit(0).cast("long"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measured(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and the measures, one row per input row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    first = docs.select(
        F.struct(*keep).alias("keep") if keep else F.lit(None).alias("keep"),
        text.alias("text"), words.alias("words"), lines.alias("lines"))
    n = F.size("words").cast("long")
    per_word = F.greatest(n, F.lit(1))
    # doubled marks at the end of a word
    marks = F.size(F.filter("words", lambda w: w.rlike(r"[!?]{2,}$"))).cast("long")
    stops = F.size(F.filter("words", lambda w: F.btrim(F.translate(w, UPPER, LOWER), F.lit(MARKS)).isin(STOP_WORDS)))
    stops = stops.cast("long")
    dup = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    second = first.select(
        "keep", n.alias("n_words"),
        _word_chars("words").alias("word_chars"),
        _count(F.col("text"), "#*$%&|<>").alias("n_symbols"),
        dup.alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        (_count(F.col("text"), "#*$%&|<>") / per_word).alias("symbols_per_word"),
        (marks / per_word).alias("marks_per_word"),
        (stops / per_word).alias("stop_word_share"),
        (dup / F.greatest(F.size("lines"), F.lit(1))).alias("dup_line_share"))
    return second.withColumn("mean_word_chars", F.col("word_chars") / F.greatest("n_words", F.lit(1)))


def _word_chars(words: str) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one boolean expression over the measures."""
    ok = F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & (F.col(r.measure) >= F.lit(r.low))
        if r.high is not None:
            ok = ok & (F.col(r.measure) <= F.lit(r.high))
    return ok


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep`` (as one struct), the measures, ``base_failed`` and ``kept``.

    Both verdicts lean on a row number, which keeps the optimizer from writing
    the measures out again inside a filter on them."""
    m = measured(docs, text_col, keep).withColumn("row", F.monotonically_increasing_id())
    m = m.withColumn("base_failed", base_failed() | (F.col("row") < 0))
    return m.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    return judge(docs, text_col, (id_col,), rules).select(
        F.col("keep")[id_col].alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input rows that pass, all columns as they were."""
    return judge(docs, text_col, tuple(docs.columns), rules).where("kept").select("keep.*")


REPORT_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
win AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
        FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
dup AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
             len(list_filter(words, lambda x: regexp_matches(x, '[!?]{{2,}}$'))) AS marks,
             len(list_filter(words, lambda x: trim(translate(x, '{upper}', '{lower}'), '{trimmed}') IN ({stops}))) AS stops
      FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, (n_words < {min_words} OR 100 * n_repeat_words > {max_rep} * n_words) AS base_failed,
             greatest(n_words, 1) AS per FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND word_chars / per BETWEEN 2.0 AND 12.0 AND n_symbols / per <= 0.1 AND marks / per <= 0.1
        AND stops / per >= 0.05 AND n_dup_lines / greatest(n_lines, 1) <= 0.5) AS kept
FROM b
""".format(stops=", ".join(f"'{w}'" for w in STOP_WORDS), min_words=MIN_WORDS, max_rep=MAX_REPEAT_PERCENT,
           upper=UPPER, lower=LOWER, trimmed=MARKS.replace("'", "''"))
