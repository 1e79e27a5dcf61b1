"""Tables that a stream writes together: one commit per batch for all of them.

A batch writes every table into folders of its own attempt and then one small
manifest that names them.  Readers open only folders that a manifest names, so
an attempt that died halfway is never seen, and a batch that Spark runs again
after its manifest was written is recognised and skipped.  The manifest is put
in place by a rename, the one step that must be atomic.

Files of a batch are planned from row counts: a date (or another partition
value) gets ceil(rows / ``rows_per_file``) files, its rows dealt out by a hash.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickwise.sources.layout import ROWS_PER_FILE, planned


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


@dataclass(frozen=True)
class Commit:
    """One manifest: its place in the order, the tables' folders, and facts about the batch."""
    batch: int
    step: int          # 0 for a batch of the stream, 1 for what follows it before the next one
    tables: dict[str, list[str]]
    facts: dict


class Store:
    def __init__(self, spark: SparkSession, root: str, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.root, self.rows_per_file = spark, root.rstrip("/"), rows_per_file

    def commits(self) -> list[Commit]:
        """All commits in order."""
        fs, folder = _fs(self.spark, f"{self.root}/_commits")
        if not fs.exists(folder):
            return []
        names = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
        found = []
        for path in names:
            stream = fs.open(path)
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            found.append(Commit(**json.loads(text)))
        return sorted(found, key=lambda c: (c.batch, c.step))

    def last(self) -> Commit | None:
        every = self.commits()
        return every[-1] if every else None

    def has(self, batch: int, step: int = 0) -> bool:
        fs, path = _fs(self.spark, self._name(batch, step))
        return fs.exists(path)

    def _name(self, batch: int, step: int) -> str:
        return f"{self.root}/_commits/{batch + 1:012d}-{step}.json"

    def attempt(self, batch: int, step: int = 0) -> Attempt:
        return Attempt(self, batch, step)

    def paths(self, name: str) -> list[str]:
        return [p for c in self.commits() for p in c.tables.get(name, [])]

    def read(self, name: str, schema: str, paths: list[str] | None = None) -> DataFrame:
        """The committed rows of a table (or of some of its folders)."""
        paths = self.paths(name) if paths is None else paths
        if not paths:
            return self.spark.createDataFrame([], schema)
        names = StructType.fromDDL(schema).fieldNames()       # without the folders' other parts
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
                .parquet(*[f"{self.root}/{p}" for p in paths]).select(*names))


class Attempt:
    """The tables of one run of a batch; nothing of it is seen before ``commit``."""

    def __init__(self, store: Store, batch: int, step: int):
        self.store, self.batch, self.step = store, batch, step
        self.name = uuid.uuid4().hex[:12]
        self.tables: dict[str, list[str]] = {}
        self.rows: dict[str, int] = {}
        self.full = False      # whether the batch holds the whole state

    def path(self, table: str) -> str:
        return f"{table}/batch_id={self.batch}/attempt={self.name}"

    def write(self, table: str, df: DataFrame, parts: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> int:
        """Write a table of this batch in files planned from its counts; returns the rows."""
        dealt, n = planned(df, parts, self.store.rows_per_file)
        self.rows[table] = n
        if n:
            if order:
                dealt = dealt.sortWithinPartitions(*parts, *order)
            dealt.write.partitionBy(*parts).parquet(f"{self.store.root}/{self.path(table)}")
            self.tables[table] = [self.path(table)]
        return n

    def scratch(self, name: str) -> str:
        return f"{self.store.root}/_work/{self.batch}-{self.step}-{self.name}/{name}"

    def commit(self, **facts) -> Commit:
        done = Commit(self.batch, self.step, self.tables, {"rows": self.rows, **facts})
        target = self.store._name(self.batch, self.step)
        fs, temporary = _fs(self.store.spark, f"{self.store.root}/_commits/.{self.name}")
        stream = fs.create(temporary, True)
        try:
            stream.write(bytearray(json.dumps(done.__dict__).encode()))
        finally:
            stream.close()
        if not fs.rename(temporary, _fs(self.store.spark, target)[1]):
            raise RuntimeError(f"batch {self.batch} was committed by another run")
        fs.delete(_fs(self.store.spark, f"{self.store.root}/_work/{self.batch}-{self.step}-{self.name}")[1], True)
        return done
