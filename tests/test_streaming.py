"""Bronze capture: file-backed message stream, availableNow, restart on one checkpoint."""

from pyspark.sql import functions as F

from helpers import day, ev, frame
from tidemark.spec import FEED_SCHEMA

from tidemark.sources.messages import to_messages, write_messages
from tidemark.streaming.ingest import ingest_available


def test_ingest_restart_and_new_file(spark, tmp_lake):
    src, bronze, ckpt = f"{tmp_lake}/topic", f"{tmp_lake}/bronze", f"{tmp_lake}/ckpt"
    first = frame(spark, [ev(f"k{i}", "INSERT", day(1 + i % 5), seq=i) for i in range(40)])
    write_messages(to_messages(first), f"{src}/a", files=4)
    batches = ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", schema=FEED_SCHEMA, options={"maxFilesPerTrigger": "1"})
    assert batches == 4
    assert spark.read.parquet(bronze).count() == 40
    # Restart with nothing new: no batch, no duplicates.
    assert ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", schema=FEED_SCHEMA) == 0
    assert spark.read.parquet(bronze).count() == 40
    # A new file arrives: only it is read.
    write_messages(to_messages(frame(spark, [ev("z", "DELETE", day(9))])), f"{src}/b", files=1)
    assert ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", schema=FEED_SCHEMA) == 1
    b = spark.read.parquet(bronze)
    assert b.count() == 41
    assert set(b.columns) >= {"tx_id", "kafka_timestamp", "ingestion_timestamp"}
    # ingestion time is constant within a micro-batch: one value per batch.
    assert b.select("ingestion_timestamp").distinct().count() == 5
    assert b.filter(F.col("tx_id") == "z").count() == 1


def test_bronze_refines_to_silver(spark, tmp_lake):
    from tidemark.plans.medallion import refine
    from tidemark.sources.tables import read_table
    from tidemark.spec import SALES_SEQ

    src, bronze, ckpt = f"{tmp_lake}/topic", f"{tmp_lake}/bronze", f"{tmp_lake}/ckpt"
    rows = [ev("a", "INSERT", day(1)), ev("a", "DELETE", day(2)), ev("b", "INSERT", day(1))]
    write_messages(to_messages(frame(spark, rows)), f"{src}/a", files=1)
    ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", schema=FEED_SCHEMA)
    assert refine(spark, bronze, f"{tmp_lake}/silver", SALES_SEQ).status == "created"
    assert [r.tx_id for r in read_table(spark, f"{tmp_lake}/silver").collect()] == ["b"]
    res = refine(spark, bronze, f"{tmp_lake}/silver", SALES_SEQ)       # rescan: idempotent merge
    assert res.status == "merged" and res.version == 1
    assert [r.tx_id for r in read_table(spark, f"{tmp_lake}/silver").collect()] == ["b"]


def test_continuous_capture_with_processing_time_trigger(spark, tmp_lake):
    from tidemark.streaming.ingest import start_bronze_ingest

    src, bronze, ckpt = f"{tmp_lake}/topic", f"{tmp_lake}/bronze", f"{tmp_lake}/ckpt"
    write_messages(to_messages(frame(spark, [ev("a", "INSERT", day(1))])), f"{src}/a", files=1)
    q = start_bronze_ingest(spark, bronze, ckpt, fmt="parquet", source_path=f"{src}/*", schema=FEED_SCHEMA,
                            trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        write_messages(to_messages(frame(spark, [ev("b", "INSERT", day(2))])), f"{src}/b", files=1)
        q.processAllAvailable()
        assert q.isActive and q.exception() is None
    finally:
        q.stop()
    assert sorted(r.tx_id for r in spark.read.parquet(bronze).collect()) == ["a", "b"]


def test_ingest_from_json_lines_text_files(spark, tmp_lake):
    """A directory of text files with one JSON message per line (no key, no broker time)."""
    from pyspark.sql import functions as F

    src, bronze, ckpt = f"{tmp_lake}/lines", f"{tmp_lake}/bronze", f"{tmp_lake}/ckpt"
    msgs = to_messages(frame(spark, [ev("a", "INSERT", day(1)), ev("b", "DELETE", day(2))]))
    msgs.select(F.col("value").cast("string").alias("value")).write.text(src)
    assert ingest_available(spark, bronze, ckpt, "text", src, schema=FEED_SCHEMA) == 1
    b = spark.read.parquet(bronze)
    assert sorted(r.tx_id for r in b.collect()) == ["a", "b"]
    assert b.filter(F.col("kafka_timestamp").isNull()).count() == 2
