import gzip
import hashlib
import os

import pytest

from tickwise.llm import warc as M

BIG = "<p>" + "x" * 200 + "</p>"
ROWS = [(5, "http://a/1", BIG), (2, "http://a/2", BIG), (9, None, BIG), (1, "u", "short"), (0, "u", "short"),
        (7, "u", None), (8, "u", ""), (None, "n", BIG), (None, "n", "<b>" + "é" * 60), (None, "m", "<b>" + "é" * 60),
        (3, "line\nbreak", "日" * 40_000), (4, "r", "y" * 100), (4, "r", "y" * 100)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string") \
        .selectExpr("*", "'q' AS payload", "1 AS first", "2 AS n", "'x' AS record_type").repartition(3)


def want():
    out = []
    for i, _, h in ROWS:
        data = (h or "").encode()
        ids = [j for j, _, g in ROWS if (g or "").encode() == data and j is not None]
        first = min(ids) if ids and len(data) >= 100 else None
        revisit = first is not None and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(pages):
    assert sorted(map(tuple, M.archive_round_trip(pages).collect()), key=str) == want()
    assert M.archive_round_trip(pages.limit(0)).count() == 0


def test_predicates_and_skipped_payloads(spark, pages, tmp_path):
    path = f"{tmp_path}/w"
    M.write_warc(pages, path)
    some = M.read_warc(spark, path).where("record_type = 'revisit' AND target_uri LIKE 'http://a/%'")
    assert [r.page_id for r in some.collect()] == [5]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan     # all predicates went into the scan
    left = M.read_warc(spark, path).where("record_type = 'revisit' AND payload_bytes > 3")
    kept = left._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in kept and "(record_type" not in kept and left.count() == 3
    skipped = M.read_warc(spark, path, payload="skip").where("record_type = 'response'").collect()
    assert skipped and all(r.payload is None and r.payload_bytes is not None for r in skipped)
    assert M.read_warc(spark, path).where("record_type = 'warcinfo'").count() >= 1


def test_payload_isn_t_decoded_for_unwanted_records(tmp_path, monkeypatch):
    row = {"record_type": "response", "page_id": 1, "target_uri": "u", "refers_to": None, "payload_digest": "d",
           "payload_bytes": 1 << 20, "payload": os.urandom(1 << 20)}
    file = tmp_path / "a.warc.gz"
    file.write_bytes(M.member(M.record(row)) * 4)
    read = []
    plain = M._Stream.read
    monkeypatch.setattr(M._Stream, "read", lambda s, n: read.append(len(got := plain(s, n))) or got)
    fs, p = M._open(str(file))
    assert list(M.records(fs, p, lambda c: False, True)) == []
    assert sum(read) < 4 * 3 * M.READ
    assert [r["payload"] for r in M.records(fs, p, lambda c: True, True)] == [row["payload"]] * 4


def test_foreign_archives(spark, tmp_path):
    row = {"record_type": "response", "page_id": 1, "target_uri": "u", "refers_to": None, "payload_digest": "d",
           "payload_bytes": 5, "payload": b"hello"}
    (tmp_path / "a.warc").write_bytes(M.record(row) + M.record(row | {"page_id": 2}))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(M.record(row | {"page_id": 3}))
                                         + gzip.compress(M.record(row | {"page_id": 4})))
    (tmp_path / "c.txt").write_text("no archive")
    got = M.read_warc(spark, str(tmp_path)).select("page_id", "payload").collect()
    assert sorted((r[0], bytes(r[1])) for r in got) == [(i, b"hello") for i in (1, 2, 3, 4)]
    assert M.read_warc(spark, str(tmp_path)).where("page_id IN (2, 4)").count() == 2


def test_rolled_files_are_planned_apart(spark, pages, tmp_path):
    path = f"{tmp_path}/w"
    M.register(spark)
    M.plan_records(pages).write.format("warc").option("roll_bytes", 200).mode("append").save(path)
    assert len([f for f in os.listdir(path) if f.endswith(".gz")]) > 6
    df = spark.read.format("warc").option("plan_bytes", 300).load(path)
    assert df.rdd.getNumPartitions() > 3 and df.where("record_type <> 'warcinfo'").count() == len(ROWS)


def http(body, *headers):
    block = "\r\n".join(["HTTP/1.1 200 OK", *headers]).encode() + b"\r\n\r\n" + body
    return b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\n" \
        + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def test_members_of_many_records(tmp_path):
    bodies = [b"a" * 10, os.urandom(100_000), b"", b"z" * 300_000]
    whole = b"".join(map(http, bodies))
    cut = len(whole) - 250_000     # members that end anywhere, also within a record
    for name, data in (("one", gzip.compress(whole)), ("two", gzip.compress(whole[:cut]) + gzip.compress(whole[cut:])),
                       ("each", b"".join(gzip.compress(http(b)) for b in bodies)), ("plain", whole)):
        file = tmp_path / f"{name}.warc.gz"
        file.write_bytes(data)
        fs, p = M._open(str(file))
        assert [r["payload"] for r in M.records(fs, p, lambda c: True, True)] == bodies, name
        assert len(list(M.records(fs, p, lambda c: True, False))) == 4
        assert list(M.records(fs, p, lambda c: False, True)) == []


def test_damaged_archives_are_told(spark, tmp_path):
    row = {"record_type": "response", "page_id": 1, "target_uri": "u", "refers_to": None, "payload_digest": "d",
           "payload_bytes": 5000, "payload": os.urandom(5000)}
    own, other = M.member(M.record(row)), gzip.compress(http(os.urandom(5000)))
    wrong = bytearray(own)
    wrong[-6] ^= 1     # the CRC
    good = 0
    for name, data in (("own", own + own[:-20]), ("other", other + other[:-20]), ("crc", own + bytes(wrong)),
                       ("plain", http(b"x" * 99) * 2 + http(b"y" * 99)[:-50]), ("text", own + b"no archive at all"),
                       ("head", other + gzip.compress(b"WARC/1.0\r\nWARC-Type: resp"))):
        file = tmp_path / f"{name}.warc.gz"
        file.write_bytes(data)
        fs, p = M._open(str(file))
        with pytest.raises(ValueError, match=f"{name}.warc.gz: damaged"):
            list(M.records(fs, p, lambda c: True, True))
        kinds = [r["record_type"] for r in M.records(fs, p, lambda c: True, True, report=True)]
        assert kinds[-1] == "damaged" and set(kinds[:-1]) == {"response"}, name
        good += len(kinds) - 1
    got = M.read_warc(spark, str(tmp_path), damaged="report").groupBy("record_type").count().collect()
    assert {r[0]: r[1] for r in got} == {"response": good, "damaged": 6}
    (tmp_path / "whole.warc.gz").write_bytes(own)
    assert M.read_warc(spark, str(tmp_path / "whole.warc.gz")).count() == 1


def test_chunked_payloads(tmp_path):
    file = tmp_path / "c.warc"
    sent, chunked = b"4;x=1\r\nwiki\r\n6\r\npedia \r\n0\r\n\r\n", "Transfer-Encoding: chunked"
    file.write_bytes(http(sent, chunked) + http(b"already joined", chunked) + http(sent))
    fs, p = M._open(str(file))
    assert [r["payload"] for r in M.records(fs, p, lambda c: True, True)] == [b"wikipedia ", b"already joined", sent]


def test_text_ids_are_an_error(pages):
    with pytest.raises(TypeError):
        M.plan_records(pages.withColumn("page_id", pages.url))


def test_payloads_of_single_pages_stay_where_they_are(pages):
    plan = M.plan_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
