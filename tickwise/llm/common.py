"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and where it lies."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a short lineage that
    survives lost executors, computed once however many branches read it."""
    return stored(df, name)[0]


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs: it does so once the
    driver's garbage collector has found their plans unused."""
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that ``stored`` wrote and that no result reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    release(spark)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with per-task set-up: ``make()`` runs once per task and
    returns the function that maps one record batch to another."""
    ship_package(df.sparkSession)

    def run(batches):
        step = make()
        for b in batches:
            if b.num_rows:
                yield step(b)

    return df.mapInArrow(run, schema)


def rows_batch(names: list[str], types: list[pa.DataType], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names)
