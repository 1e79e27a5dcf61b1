"""Tick sources and decoding.

``tick_source`` opens the stream (a topic, or a folder of JSON / Parquet
files for tests and replays); ``decode_ticks`` turns message values into
typed ticks and splits off rows that cannot be enriched.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwise.functions.timefns import parse_event_time
from tickwise.schema import TICK_MESSAGE


@dataclass
class SourceConf:
    """Where ticks come from.

    format: "kafka" (needs the Kafka connector on the classpath), "json"
    (one message per line) or "parquet" (already-typed messages).
    """
    format: str = "kafka"
    path: str | None = None
    bootstrap_servers: str | None = None
    topic: str = "ticks"
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_per_trigger: int | None = None
    options: dict = field(default_factory=dict)


def tick_source(spark: SparkSession, conf: SourceConf) -> DataFrame:
    """Streaming DataFrame of raw messages.

    Kafka yields ``value`` (bytes) plus partition/offset, which give a
    unique ``seq`` for ordering equal event times.  File formats yield
    the message columns directly.  ``max_per_trigger`` bounds a
    micro-batch (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``).
    """
    rs = spark.readStream
    if conf.format == "kafka":
        r = (rs.format("kafka")
               .option("kafka.bootstrap.servers", conf.bootstrap_servers)
               .option("subscribe", conf.topic)
               .option("startingOffsets", conf.starting_offsets)
               .option("failOnDataLoss", str(conf.fail_on_data_loss).lower()))
        if conf.max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", conf.max_per_trigger)
        for k, v in conf.options.items():
            r = r.option(k, v)
        return r.load().select(
            F.col("value").cast("string").alias("value"),
            (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("seq"))
    if conf.format == "json":
        r = rs.format("text")
        if conf.max_per_trigger:
            r = r.option("maxFilesPerTrigger", conf.max_per_trigger)
        return r.load(conf.path).where(F.trim("value") != "")
    if conf.format == "parquet":
        r = rs.format("parquet").schema(conf.options.get("schema"))
        if conf.max_per_trigger:
            r = r.option("maxFilesPerTrigger", conf.max_per_trigger)
        return r.load(conf.path)
    raise ValueError(f"unknown source format {conf.format!r}")


# Event times that a feed can have; wider than any source's clock error and delay.
MAX_AHEAD = "1 day"
MAX_AGE = "3650 days"


def _utc_now():
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def decode_ticks(messages: DataFrame, value_col: str = "value", source_tz: str | None = None,
                 tz_by_type: dict | None = None, max_ahead: str = MAX_AHEAD,
                 max_age: str = MAX_AGE) -> DataFrame:
    """JSON message -> typed tick with ``event_time``, ``date`` and a
    ``quarantine`` reason (null when the row is good).

    Decoding is ANSI-safe: malformed JSON or a malformed timestamp makes
    a quarantined row, never a failed job.  Wall-clock timestamps are
    read in ``source_tz``, or per ``data_type`` with ``tz_by_type``
    (e.g. {"real": "America/New_York"}), and converted to UTC.

    Event times later than now + ``max_ahead`` or older than ``max_age`` are
    quarantined: one of them would move a stream's watermark, or be behind it,
    and cost other rows.
    """
    parsed = messages.select(
        "*", F.from_json(F.col(value_col), TICK_MESSAGE,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("_m"))
    cols = [F.col(f"_m.{f.name}").alias(f.name) for f in TICK_MESSAGE.fields]
    keep = [c for c in messages.columns if c != value_col and c not in TICK_MESSAGE.fieldNames()]
    out = parsed.select(*keep, *cols, F.col(value_col).alias("_raw"),
                        F.col("_m").isNull().alias("_bad_json"))
    et = parse_event_time(F.col("timestamp"), source_tz=source_tz)
    for dtype, tz in (tz_by_type or {}).items():
        et = F.when(F.col("data_type") == dtype,
                    parse_event_time(F.col("timestamp"), source_tz=tz)).otherwise(et)
    out = out.withColumn("event_time", et).withColumn("date", F.to_date("event_time"))
    reason = (F.when(F.col("_bad_json"), F.lit("malformed_json"))
               .when(F.col("symbol").isNull() & F.col("close").isNull(), F.lit("malformed_json"))
               .when(F.col("event_time").isNull(), F.lit("bad_timestamp"))
               .when(F.col("symbol").isNull(), F.lit("null_symbol"))
               .when(F.col("close").isNull(), F.lit("null_close"))
               .when(F.col("event_time") > _utc_now() + F.expr(f"INTERVAL {max_ahead}"), F.lit("future_timestamp"))
               .when(F.col("event_time") < _utc_now() - F.expr(f"INTERVAL {max_age}"), F.lit("old_timestamp")))
    return out.withColumn("quarantine", reason).drop("_bad_json")


def good_ticks(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("quarantine").isNull()).drop("quarantine", "_raw")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("quarantine").isNotNull()).select("quarantine", "_raw")


def encode_ticks(ticks: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Tick rows -> (key, value) JSON messages for a topic or files.

    Null fields are written as JSON null so every message carries the
    full field list.  ``keep`` passes extra columns through.
    """
    fields = [F.col(f.name) for f in TICK_MESSAGE.fields]
    return ticks.select(F.col("symbol").alias("key"),
                        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
                        *keep)


def publish_ticks(ticks: DataFrame, bootstrap_servers: str, topic: str = "ticks",
                  options: dict | None = None) -> None:
    """Publish tick rows as JSON messages keyed by symbol (batch write).

    Keying by symbol keeps one symbol's ticks in one topic partition, so
    the (partition, offset) ``seq`` of a consumer follows publish order.
    Needs the Kafka connector on the classpath; ``acks=all`` by default.
    """
    w = (encode_ticks(ticks).write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", topic)
         .option("kafka.acks", "all"))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()
