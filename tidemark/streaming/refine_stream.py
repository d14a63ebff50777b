"""Incremental refine: Bronze → latest-event state, one micro-batch of new files at a time.

The batch refine rescans all of Bronze on every run.  This job gives the same Silver
while reading each Bronze file once: a Structured Streaming query over the Bronze
directory (its checkpoint records which files were processed) merges every micro-batch
into a *state* table holding the latest valid event per key, deletes included as
tombstones.  Because "latest" is a maximum, merging batch after batch equals
deduplicating everything at once, and a late, older event can never resurrect a deleted
key (the tombstone is newer).  Silver is the state without tombstones.

Each micro-batch is one Spark job: clean → latest per key → newest-wins full outer join
with the state (read in place: the state is bucketed by key and the job's shuffle width
equals the bucket count) → new state version.  A replayed micro-batch (after a failure
before the checkpoint commit) merges to the same state, so the sink is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.refine import clean, current_from_state, latest_per_key, state_columns, upsert_newest
from ..plans.sizing import merge_width, silver_buckets
from ..session import ensure_session, shuffle_width
from ..sources.tables import bucketing, publish, read_table, table_exists
from ..spec import SALES, ChangeSpec


def merge_batch(batch: DataFrame, state_path: str, spec: ChangeSpec = SALES, buckets: int | None = None,
                batch_id: int | None = None) -> int | None:
    """Merge one batch of Bronze rows into the state table; returns the new version."""
    spark = batch.sparkSession
    seen = Observation(f"clean_events_{batch_id}")
    cleaned = clean(batch, spec).observe(seen, F.count(F.lit(1)).alias("n"))
    has_events = lambda: seen.get["n"] > 0
    meta = {"batch_id": batch_id} if batch_id is not None else {}
    if table_exists(spark, state_path):
        b = bucketing(spark, state_path)
        n = merge_width(b[0] if b else None, buckets)
        with shuffle_width(spark, n):
            obs = Observation(f"upsert_{batch_id}")
            new_state = upsert_newest(read_table(spark, state_path), latest_per_key(cleaned, spec), spec, obs)
            return publish(new_state, state_path, "MERGE", metrics=meta, metrics_fn=lambda: obs.get,
                           bucket_by=(n, spec.key) if n else None, commit_if=has_events, kind="state")
    n = buckets if buckets is not None else int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffle_width(spark, n or None):
        first = latest_per_key(cleaned, spec).select(*state_columns(spec))
        return publish(first, state_path, "WRITE", metrics=meta, bucket_by=(n, spec.key) if n else None,
                       commit_if=has_events, kind="state")


def refine_incremental(spark: SparkSession, bronze_path: str, state_path: str, checkpoint: str,
                       spec: ChangeSpec = SALES, buckets: int | None = None, timeout_s: float | None = None,
                       options: dict[str, str] | None = None) -> str:
    """Process the Bronze files not seen yet (``availableNow``), then stop.

    ``options`` go to the Bronze file stream, e.g. ``{"maxFilesPerTrigger": "1000"}`` to
    work through a large backlog in bounded micro-batches (each one committed on its own).
    There is no time limit unless ``timeout_s`` sets one.  Returns ``no_bronze`` when there is no Bronze yet, else ``done``.
    """
    ensure_session(spark)
    if not table_exists(spark, bronze_path):
        return "no_bronze"
    if buckets is None:
        buckets = silver_buckets(spark, bronze_path)
    schema = spark.read.parquet(bronze_path).schema
    stream = spark.readStream.schema(schema).options(**(options or {})).parquet(bronze_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, state_path, spec, buckets, batch_id)

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    try:
        if not (q.awaitTermination() or True if timeout_s is None else q.awaitTermination(timeout_s)):
            raise TimeoutError("incremental refine did not finish in time")
        if q.exception() is not None:
            raise q.exception()
    finally:
        q.stop()
    return "done"


def silver_view(spark: SparkSession, state_path: str, spec: ChangeSpec = SALES) -> DataFrame:
    """Silver as a view of the state: the latest event of every key that is not a delete."""
    return current_from_state(read_table(spark, state_path), spec)
