"""Bronze capture: a continuous, append-only Structured Streaming query.

Message source → ``CAST(value AS STRING)`` → ``from_json`` with the event schema → event
fields + ``kafka_timestamp`` + ``ingestion_timestamp`` → parquet file sink with a
checkpoint.  The query is a stateless map, so it scales with source partitions, keeps
no state between micro-batches and restarts exactly where the checkpoint left off.
In production the source is ``kafka`` (``subscribe``, ``startingOffsets=earliest``,
``failOnDataLoss=false``); in tests a directory of message files stands in for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from ..sources.messages import to_bronze
from ..spec import EVENT_SCHEMA
from .progress import ProgressTable, measured

# Record shape of a broker topic, used when the source is a file stand-in.
MESSAGE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])

# --- fixed values: source defaults of the capture job ---
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
EVENT_DAY = "event_day"
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
# --- end of fixed values ---


def message_stream(spark: SparkSession, fmt: str = "kafka", options: dict[str, str] | None = None,
                   path: str | None = None) -> DataFrame:
    """Unbounded message stream; ``fmt='kafka'`` takes broker options, file formats a path.

    For Kafka, ``minPartitions`` defaults to the cluster's task slots: the source then
    splits the offset range of a large topic partition over several tasks, so one hot
    partition (say a third of the feed) does not become one long task.  On a large
    backlog, pass ``maxOffsetsPerTrigger`` so the first micro-batches commit progress
    in bounded steps.
    """
    opts = dict(KAFKA_DEFAULTS if fmt == "kafka" else {})
    if fmt == "kafka":
        opts["minPartitions"] = str(spark.sparkContext.defaultParallelism)
    opts.update(options or {})
    reader = spark.readStream.format(fmt).options(**opts)
    if fmt not in ("kafka", "text"):          # text: one JSON message per line, column ``value``
        reader = reader.schema(MESSAGE_SCHEMA)
    return reader.load(path) if path else reader.load()


def start_bronze_ingest(spark: SparkSession, bronze_path: str, checkpoint: str, fmt: str = "kafka",
                        options: dict[str, str] | None = None, source_path: str | None = None,
                        schema: StructType = EVENT_SCHEMA, trigger: dict | None = None,
                        query_name: str | None = None, by_day: bool = False,
                        measure: str | None = None) -> StreamingQuery:
    """Start the capture; ``trigger`` is e.g. ``{"processingTime": "10 seconds"}`` or
    ``{"availableNow": True}`` (drain what is there, then stop).  With ``by_day`` Bronze is
    partitioned by ``event_day``, the date part of the event time as it was sent; ``measure`` names the key
    column of the rows that a progress table counts (``streaming.progress``)."""
    bronze = to_bronze(message_stream(spark, fmt, options, source_path), schema)
    if measure:
        bronze = measured(bronze, measure)
    if by_day:
        bronze = bronze.withColumn(EVENT_DAY, F.substring("timestamp", 1, 10))
    w = (bronze.writeStream.format("parquet").outputMode("append")
               .option("checkpointLocation", checkpoint)
               .trigger(**(trigger or DEFAULT_TRIGGER)))
    if by_day:
        w = w.partitionBy(EVENT_DAY)
    if query_name:
        w = w.queryName(query_name)
    return w.start(bronze_path)


def ingest_available(spark: SparkSession, bronze_path: str, checkpoint: str, fmt: str, source_path: str | None = None,
                     options: dict[str, str] | None = None, schema: StructType = EVENT_SCHEMA,
                     timeout_s: float | None = None, by_day: bool = False, progress_path: str | None = None,
                     key: str = "tx_id") -> int:
    """Run the capture once over everything available, then stop; returns batches run.  There
    is no time limit unless ``timeout_s`` sets one.  With ``progress_path`` every batch's figures
    go to a batch-progress table there."""
    log = ProgressTable(spark, progress_path) if progress_path else None
    if log:
        spark.streams.addListener(log)
    try:
        batches = _drain(spark, bronze_path, checkpoint, fmt, options, source_path, schema, timeout_s, by_day, key if log else None, log)
        if log:
            log.finish()
        return batches
    finally:
        if log:
            spark.streams.removeListener(log)


def _drain(spark, bronze_path, checkpoint, fmt, options, source_path, schema, timeout_s, by_day, measure, log) -> int:
    q = start_bronze_ingest(spark, bronze_path, checkpoint, fmt, options, source_path, schema,
                            trigger={"availableNow": True}, by_day=by_day, measure=measure)
    if log:
        log.follow(q)
    try:
        if not (q.awaitTermination() or True if timeout_s is None else q.awaitTermination(timeout_s)):
            raise TimeoutError("bronze ingest did not drain the source in time")
        if q.exception() is not None:
            raise q.exception()
        return sum(1 for p in q.recentProgress if p.get("numInputRows", 0) > 0)
    finally:
        q.stop()
