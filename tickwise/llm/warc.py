"""WARC archives as a PySpark Python data source.

``spark.read.format("warc").load(path)`` plans one partition per group of whole
archive files, takes predicates on the record type and the other headers into
the scan, and reads the headers of a record first: a record that fails a
predicate is skipped without decoding its payload.  Written archives are gzip
files of one member per record, whose length stands in the member's extra field
so that a reader can jump over it; rolled over at ``roll_bytes``.  Any file
system that pyarrow can open by URI works.

A write names its files in ``_manifest`` on commit, so files of lost or repeated
tasks are never read; a folder without a manifest is read by file name.

Record columns: record_type, record_id, target_uri, page_id, refers_to,
payload_digest, payload_bytes (headers), payload (decoded; null with option
``payload=skip`` and for records without one; chunks of a transfer are joined).
Archives of other writers may be plain, or hold any number of records in a gzip
member.  A damaged archive is an error, or with option ``damaged=report`` a
record of type ``damaged`` that names the file.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import IntegralType

from ..session import ship_package
from .common import cut, scratch

SCHEMA = ("record_type string, record_id string, target_uri string, page_id long, refers_to long, "
          "payload_digest string, payload_bytes long, payload binary")
ARROW = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
                   ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                   ("payload_bytes", pa.int64()), ("payload", pa.binary())])
HEADERS = frozenset(ARROW.names[:-1])
#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SMALLEST_SHARED = 100     # payloads below this many bytes are always stored
MEMBER = struct.Struct("<4sIBBH2sHII")   # gzip header with one extra field: the lengths of member and data
ROLL_BYTES = 64 << 20
PLAN_BYTES = 64 << 20     # archive bytes that a partition reads
READ = 1 << 14
WIDE = 1 << 20            # read at once of a payload that is wanted
ROWS = 256
BATCH_BYTES = 4 << 20


def member(data: bytes) -> bytes:
    """One gzip member that carries its own length."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    return MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, MEMBER.size + len(body) + 8,
                       len(data) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record(row: dict) -> bytes:
    """A response or revisit record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    digest, revisit = row["payload_digest"], row["record_type"] == "revisit"
    block = http if revisit else http + row["payload"]
    lines = [f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_id(row['page_id'], digest)}",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {row['payload_bytes']}"]
    if row["target_uri"] is not None:   # a header is one line
        lines.append("WARC-Target-URI: " + "".join(row["target_uri"].splitlines()))
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(row['refers_to'], digest)}",
                  f"X-Refers-To-Page-Id: {row['refers_to']}"]
    lines.append(f"Content-Length: {len(block)}")
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, roll_bytes: int):
        self.path, self.roll = path.rstrip("/"), roll_bytes

    def write(self, iterator) -> _Written:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        out, size, files = None, 0, []
        for b in iterator:
            for row in b.to_pylist():
                if out is None:
                    files.append(f"pages-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    info = b"software: tickwise\r\nformat: WARC File Format 1.1\r\n"
                    size += out.write(member(
                        VERSION + f"WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                        f"WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\n"
                        f"Content-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n")) or 0
                data = member(record(row))
                out.write(data)
                size += len(data)
                if size >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        names = sorted(f for m in messages if m for f in m.files)
        with fs.open_output_stream(f"{root}/_manifest", compression=None) as out:
            out.write("\n".join(names).encode())

    def abort(self, messages) -> None:
        fs, root = _open(self.path)
        for m in messages:
            for f in m.files if m else ():
                fs.delete_file(f"{root}/{f}")


class Damaged(Exception):
    """An archive that ends within a record, or holds something else."""


class _Stream:
    """A forward reader with cheap jumps."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        self.at, self.size, self.buffer, self.start = 0, self.file.size(), b"", 0

    def _fetch(self, n: int) -> None:
        self.start = self.at
        self.buffer = self.file.read_at(min(max(n, READ), self.size - self.at), self.at)

    def read(self, n: int) -> bytes:
        """At most ``n`` bytes, none only at the end."""
        if not 0 <= self.at - self.start < len(self.buffer):
            self._fetch(n)
        lo = self.at - self.start
        out = self.buffer[lo:lo + n]
        self.at += len(out)
        return out

    def peek(self, n: int) -> bytes:
        lo = self.at - self.start
        if lo < 0 or lo + n > len(self.buffer):
            self._fetch(n)
            lo = 0
        return self.buffer[lo:lo + n]


class _Body:
    """The bytes of records from where a stream stands up to ``end``: as they lie there, or
    out of the gzip members, whatever number of records each of them holds."""

    def __init__(self, stream: _Stream, zipped: bool, end: int):
        self.stream, self.zipped, self.end = stream, zipped, end
        self.inflate, self.buffer = None, b""

    def fill(self, step: int = READ) -> bool:
        """Put the next bytes in the empty buffer; False at the end."""
        s = self.stream
        if not self.zipped:
            self.buffer = s.read(min(step, self.end - s.at))
            return bool(self.buffer)
        while True:
            if self.inflate is not None and self.inflate.eof:
                s.at -= len(self.inflate.unused_data)
                self.inflate = None
            if self.inflate is None:
                if s.at >= self.end:
                    return False
                self.inflate = zlib.decompressobj(31)     # checks length and CRC of a member, too
            chunk = self.inflate.unconsumed_tail or s.read(min(step, self.end - s.at))
            self.buffer = self.inflate.decompress(chunk, step)
            if self.buffer:
                return True
            if not chunk and not self.inflate.eof:
                raise Damaged("a gzip member is cut short")

    def head(self) -> bytes | None:
        """The next record's header lines; None behind the last record."""
        data = b""
        while True:
            data = (data + self.buffer).lstrip(b"\r\n")
            if not data.startswith(b"WARC/"[:len(data)]):
                raise Damaged("no record begins here")
            end = data.find(b"\r\n\r\n")
            if end >= 0:
                self.buffer = data[end + 4:]
                return data[:end]
            self.buffer = b""
            if not self.fill():
                if data:
                    raise Damaged("the headers of a record are cut short")
                return None

    def take(self, n: int, keep: bool, step: int) -> bytes:
        """The next ``n`` bytes; without ``keep`` they are passed over."""
        parts = []
        while True:
            part, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(part)
            if keep:
                parts.append(part)
            if not n:
                return b"".join(parts)
            if not keep and not self.zipped and self.stream.at + n <= self.end:
                self.stream.at += n
                return b""
            if not self.fill(step):
                raise Damaged("the block of a record is cut short")


def _headers(head: bytes) -> dict[str, str]:
    out, last = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            k, v = line.split(":", 1)
            last = k.strip().lower()
            out[last] = v.strip()
    return out


def _columns(h: dict[str, str]) -> dict:
    digest = h.get("warc-payload-digest")
    number = {k: int(h[k]) if h.get(k, "").lstrip("-").isdigit() else None
              for k in ("x-page-id", "x-refers-to-page-id", "x-payload-length")}
    return {"record_type": h.get("warc-type"), "record_id": h.get("warc-record-id"),
            "target_uri": h.get("warc-target-uri"), "page_id": number["x-page-id"],
            "refers_to": number["x-refers-to-page-id"],
            "payload_digest": digest.split(":", 1)[-1] if digest else None,
            "payload_bytes": number["x-payload-length"]}


CHUNK = re.compile(rb"([0-9A-Fa-f]{1,8})[^\r\n]*\r\n")


def _joined_chunks(body: bytes) -> bytes:
    """A body sent in chunks put together; as it is if it isn't made of whole chunks."""
    parts, at = [], 0
    while m := CHUNK.match(body, at):
        n = int(m[1], 16)
        if not n:
            return b"".join(parts)
        at = m.end() + n
        if body[at:at + 2] != b"\r\n":
            break
        parts.append(body[m.end():at])
        at += 2
    return body


def _payload(h: dict[str, str], block: bytes) -> bytes | None:
    if h.get("warc-type") == "revisit":
        return None
    if not h.get("content-type", "").startswith("application/http"):
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    return _joined_chunks(body) if _headers(head).get("transfer-encoding", "").lower() == "chunked" else body


def _one(body: _Body, wanted, payload: bool, step: int) -> dict | None:
    """The next record, ``{}`` if it isn't wanted, None behind the last one."""
    head = body.head()
    if head is None:
        return None
    h = _headers(head)
    if not h.get("content-length", "").isdigit():
        raise Damaged("a record without a length")
    cols, n = _columns(h), int(h["content-length"])
    keep = wanted(cols)
    if body.zipped and step > READ and not (keep and payload):
        return cols | {"payload": None} if keep else {}     # a member of known length is jumped over
    block = body.take(n, keep and payload, step)
    return cols | {"payload": _payload(h, block) if payload else None} if keep else {}


def _records(s: _Stream, wanted, payload: bool) -> Iterator[dict]:
    while s.at < s.size:
        s.begin, lead = s.at, s.peek(MEMBER.size)
        length = None
        if lead[:2] == b"\x1f\x8b" and len(lead) == MEMBER.size:
            sign, _, _, _, extra, name, size, n, _ = MEMBER.unpack(lead)
            length = n if sign[3] == 4 and extra == 12 and name == b"sl" and size == 8 else None
        if length:       # one record, whose member says how long it is
            if s.begin + length > s.size:
                raise Damaged("a gzip member is cut short")
            body = _Body(s, True, s.begin + length)
            r = _one(body, wanted, payload, WIDE)
            if r and payload:
                while body.fill(WIDE):    # to the member's CRC
                    pass
            s.at = s.begin + length
            if r:
                yield r
            continue
        body = _Body(s, lead[:2] == b"\x1f\x8b", s.size)
        while (r := _one(body, wanted, payload, READ)) is not None:
            s.begin = s.at
            if r:
                yield r


def records(fs: pafs.FileSystem, path: str, wanted, payload: bool, report: bool = False) -> Iterator[dict]:
    """Records of one archive whose header columns pass ``wanted``.

    An archive that is cut short, fails a CRC or holds something else is an error that
    names the file; with ``report`` it gives a record of type ``damaged`` instead, whose id
    is the file and a place at or before the damage, and the file is left there."""
    s = _Stream(fs, path)
    try:
        yield from _records(s, wanted, payload)
    except (Damaged, zlib.error) as e:
        if not report:
            raise ValueError(f"{path}: damaged after byte {s.begin}: {e}") from e
        cols = _columns({}) | {"record_type": "damaged", "record_id": f"{path}@{s.begin}"}
        if wanted(cols):
            yield cols | {"payload": None}


class _Files(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(files)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "decode") != "skip"
        self.report = options.get("damaged", "fail") == "report"
        self.plan_bytes = int(options.get("plan_bytes", PLAN_BYTES))
        self.filters: list[Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            known = isinstance(f, EqualTo | EqualNullSafe | In | IsNotNull | StringStartsWith)
            if known and f.attribute[0] in HEADERS and len(f.attribute) == 1:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        fs, root = _open(self.path)
        manifest = fs.get_file_info(f"{root}/_manifest")
        if manifest.type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/_manifest", compression=None) as f:
                names = f.read().decode().split("\n")
            infos = fs.get_file_info([f"{root}/{n}" for n in names if n])
        elif fs.get_file_info(root).type == pafs.FileType.File:
            infos = [fs.get_file_info(root)]
        else:
            infos = [i for i in fs.get_file_info(pafs.FileSelector(root, recursive=True))
                     if i.path.endswith((".warc", ".warc.gz"))]
        out, size = [[]], 0
        for i in sorted(infos, key=lambda i: i.path):
            if out[-1] and size + i.size > self.plan_bytes:
                out.append([])
                size = 0
            out[-1].append(i.path)
            size += i.size
        return [_Files(p) for p in out]

    def _wanted(self, cols: dict) -> bool:
        for f in self.filters:
            v = cols[f.attribute[0]]
            ok = (v is not None if isinstance(f, IsNotNull)
                  else v in f.value if isinstance(f, In)
                  else v is not None and v.startswith(f.value) if isinstance(f, StringStartsWith)
                  else v == f.value and (v is not None or isinstance(f, EqualNullSafe)))
            if not ok:
                return False
        return True

    def read(self, partition):
        fs, _ = _open(self.path)
        rows, size = [], 0
        for path in partition.value if partition else ():
            for r in records(fs, path, self._wanted, self.payload, self.report):
                rows.append(r)
                size += len(r["payload"] or b"")
                if len(rows) >= ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], int(self.options.get("roll_bytes", ROLL_BYTES)))


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """Records to write: the payload, its digest, and whether it revisits another page.

    Among equal payloads of at least ``SMALLEST_SHARED`` bytes the smallest page
    id is the response (all rows that share that id are); null ids come last and
    are responses where no id is known.  A null page is an empty payload.  Ids that
    aren't whole numbers are an error, since records carry them as such."""
    if not isinstance(pages.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be a whole number, not {pages.schema[id_col].dataType.simpleString()}")
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    p = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("target_uri"), payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    shared = p.where(F.col("payload_bytes") >= SMALLEST_SHARED).groupBy("payload_digest") \
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1") \
        .select("payload_digest", "first")
    # written first, so that its size is known before a payload has to move for the join
    shared = cut(shared, "warc-digests")
    q = p.join(shared, "payload_digest", "left")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return q.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.lit(None).cast("string").alias("record_id"),
        "target_uri", "page_id", F.when(revisit, F.col("first")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(revisit, F.lit(None)).otherwise(F.col("payload")).alias("payload"))


def write_warc(pages: DataFrame, path: str, **names: str) -> None:
    """Archive a table of pages; see ``plan_records`` for the columns."""
    register(pages.sparkSession)
    plan_records(pages, **names).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def archive_round_trip(pages: DataFrame, **names: str) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back; the
    length and digest of a response are those of the payload that was read."""
    path = scratch(pages.sparkSession, "warc")
    write_warc(pages, path, **names)
    back = read_warc(pages.sparkSession, path).where(F.col("record_type").isin("response", "revisit"))
    stored = F.col("payload").isNotNull()
    return back.select(
        "page_id", F.when(stored, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


ROUND_TRIP_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
