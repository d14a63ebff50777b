"""Keyed JSON change messages: encode a feed into messages, decode messages into events.

Messages have the broker record shape (``key``, ``value`` as bytes, ``timestamp``), so
the same decode serves a Kafka source in production and a file source in tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..spec import FEED_SCHEMA

MESSAGE_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def to_messages(df: DataFrame, key: str = "tx_id", columns: list[str] | None = None,
                topic: str = "sales", time: Column | None = None) -> DataFrame:
    """One message per row: key = key column as UTF-8 bytes, value = JSON object bytes.

    Null fields are left out of the JSON object, as a JSON encoder of the event dict
    would write them; decoding restores them as nulls.
    """
    cols = columns or df.columns
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in cols])).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        (time if time is not None else F.current_timestamp()).alias("timestamp"),
    )


def decode_messages(messages: DataFrame, schema: StructType = FEED_SCHEMA) -> DataFrame:
    """Bronze projection of raw messages: the parsed event fields plus ``kafka_timestamp``.

    ``from_json`` runs permissive (no mode option): malformed payloads give all-null
    fields, a wrongly typed field gives null for that field only, unknown fields are
    dropped.  Nothing is rejected here — cleaning happens in the refine step.
    """
    value = F.col("value").cast("string")
    has_ts = "timestamp" in messages.columns
    parsed = messages.select(
        F.from_json(value, schema).alias("data"),
        (F.col("timestamp") if has_ts else F.lit(None).cast("timestamp")).alias("kafka_timestamp"),
    )
    return parsed.select("data.*", "kafka_timestamp")


def to_bronze(messages: DataFrame, schema: StructType = FEED_SCHEMA) -> DataFrame:
    """Decode and stamp with the capture time (constant within one micro-batch)."""
    return decode_messages(messages, schema).withColumn("ingestion_timestamp", F.current_timestamp())


def read_messages(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                  path: str | None = None) -> DataFrame:
    """Bounded read of a message source (``kafka`` with starting/ending offsets, or files)."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return reader.load(path) if path else reader.load()


def peek(messages: DataFrame, n: int = 10, order_by: list[Column] | None = None,
         schema: StructType = FEED_SCHEMA) -> DataFrame:
    """First ``n`` decoded events of a bounded message read (top-n when an order is given)."""
    events = decode_messages(messages, schema)
    if order_by:
        events = events.orderBy(*order_by)
    return events.limit(n)


def write_messages(messages: DataFrame, path: str | None = None, files: int | None = None, fmt: str = "parquet",
                   options: dict[str, str] | None = None) -> None:
    """Publish messages: to a broker (``fmt='kafka'``, ``options`` with servers and
    ``topic``; only ``key`` and ``value`` are sent) or as files (the topic stand-in)."""
    if fmt == "kafka":
        messages.select("key", "value").write.format("kafka").options(**(options or {})).save()
        return
    out = messages.repartition(files) if files else messages
    out.write.mode("errorifexists").format(fmt).options(**(options or {})).save(path)
