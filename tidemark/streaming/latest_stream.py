"""Latest event per key kept in a streaming state store.

A stream of events is cleaned and aggregated by key with ``max_by`` over the order columns; the
state store holds one event a key (RocksDB: on local disk, with its changes in the checkpoint).
In update mode every micro-batch gives the keys whose latest event may have changed; they go to
``batch=<id>`` folders, which a replayed batch writes again, so a failure between write and
commit changes nothing.  The latest table is the last row given for each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.refine import clean
from ..session import ensure_session
from ..spec import SALES_SEQ, ChangeSpec

# --- fixed values: Spark's state store on local disk ---
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
# --- end of fixed values ---


def latest_by_state(events: DataFrame, spec: ChangeSpec = SALES_SEQ) -> DataFrame:
    """Newest valid event of every key as an aggregation, for batch and stream alike.  Events
    that are equal in all order columns are taken in any order."""
    newest = F.max_by(F.struct(*[F.col(c) for c in events.columns]), F.struct(*spec.order_by))
    return clean(events, spec).groupBy(F.col(spec.key).alias("_key")).agg(newest.alias("_event")).select("_event.*")


def run_latest(spark: SparkSession, events_path: str, changes_path: str, checkpoint: str,
               spec: ChangeSpec = SALES_SEQ, options: dict[str, str] | None = None) -> None:
    """Take in all events not seen yet (``availableNow``), then stop; a later call goes on from the checkpoint."""
    ensure_session(spark)
    old = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        schema = spark.read.parquet(events_path).schema
        stream = spark.readStream.schema(schema).options(**(options or {})).parquet(events_path)

        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{changes_path}/batch={batch_id}")

        q = (latest_by_state(stream, spec).writeStream.outputMode("update").foreachBatch(keep)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        finally:
            q.stop()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def latest_table(spark: SparkSession, changes_path: str, spec: ChangeSpec = SALES_SEQ) -> DataFrame:
    """The latest event of every key: the row of its last batch."""
    changes = spark.read.parquet(changes_path)
    cols = [c for c in changes.columns if c != "batch"]
    last = F.max_by(F.struct(*cols), "batch")
    return changes.groupBy(F.col(spec.key).alias("_key")).agg(last.alias("_event")).select("_event.*")
