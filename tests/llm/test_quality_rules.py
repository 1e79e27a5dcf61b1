import re
from collections import Counter

from tickwise.llm import quality_rules as M
from .conftest import EDGE

SMALL = str.maketrans(M.UPPER, M.LOWER)
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def measure(text):
    w = WORDS(text or "")
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {p for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORDS(x)]
    n = len(w)
    base = n < 50 or 100 * len(covered) > 50 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    chars, per = sum(map(len, w)), max(1, n)
    kept = not base and 2 <= chars / per <= 12 and symbols / per <= 0.1 \
        and sum(bool(re.search(r"[!?]{2,}$", x)) for x in w) / per <= 0.1 \
        and sum(x.translate(SMALL).strip(M.MARKS) in M.STOP_WORDS for x in w) / per >= 0.05 \
        and (len(lines) - len(set(lines))) / max(1, len(lines)) <= 0.5
    return n, chars, symbols, len(lines) - len(set(lines)), len(covered), base, kept


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in M.quality_report(docs).collect()}
    assert got == {r.doc_id: measure(r.text) for r in docs.collect()}


def test_edges(edge, empty):
    got = sorted(map(tuple, M.quality_report(edge).collect()), key=str)
    assert got == sorted(((i, *measure(t)) for i, t, _, _ in EDGE), key=str)
    assert M.quality_report(empty).count() == 0
    assert M.keep_good(empty).columns == empty.columns and M.keep_good(edge).count() == 0


def test_one_projection(edge):
    plan = M.quality_report(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_rejects_junk_and_keeps_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = M.quality_report(docs).join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count()
    assert {(r.quality, r.kept) for r in rows.collect()} == {(0, False), (1, True)}


def test_stop_words_in_any_case_and_with_marks(spark):
    import duckdb
    text = " ".join(f"Wort{i} {w}" for i, w in enumerate(["THE", "The,", "(and", "“für”", "MÁS", "'it'", "o’the", "İN", "ſ"] * 4))
    rows = [(1, text), (2, " ".join(f"Wort{i}" for i in range(60))), (3, " ".join(f"{w}{w}x {w}" for w in M.STOP_WORDS)),
            (4, " ".join(f"Wort{i}" for i in range(57)) + " NÃO HET Che."), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, M.quality_report(df).collect()))
    assert got == [(i, *measure(t)) for i, t in rows] and [r[-1] for r in got] == [True, False, True, True, False]
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert sorted(con.execute(M.REPORT_SQL).fetchall()) == got
