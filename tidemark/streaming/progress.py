"""Batch-progress table of a capture: one row per micro-batch, from Spark's own progress events.

The capture measures its rows with ``observe`` inside the stream, in the job that writes them;
a ``StreamingQueryListener`` writes each finished batch's figures to ``batch=<id>``, so a batch
that runs again after a failure replaces its row.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRICS = "captured"
PROGRESS_SCHEMA = "batch_id bigint, captured_rows bigint, rows_without_key bigint"


def measured(bronze: DataFrame, key: str) -> DataFrame:
    """The stream, observed: its rows, and those that no key could be read from."""
    return bronze.observe(METRICS, F.count(F.lit(1)).alias("captured_rows"), F.count_if(F.col(key).isNull()).alias("rows_without_key"))


class ProgressTable(StreamingQueryListener):
    """Writes the observed figures of one run's batches below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.run_id: str | None = None
        self.early: list = []
        self.lock, self.ended = threading.Lock(), threading.Event()
        self.failure: BaseException | None = None

    def follow(self, query: StreamingQuery) -> None:
        """Batches that ended before the run's id was known are written now."""
        with self.lock:
            self.run_id = str(query.runId)
            early, self.early = self.early, []
            for progress in early:
                self._write(progress)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            if self.run_id is None:
                self.early.append(event.progress)
            else:
                self._write(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            if self.run_id in (None, str(event.runId)):
                self.ended.set()

    def _write(self, progress) -> None:
        seen = progress.observedMetrics.get(METRICS)
        if str(progress.runId) != self.run_id or seen is None or not seen["captured_rows"]:
            return
        try:
            row = self.spark.range(1).select(F.lit(progress.batchId).cast("bigint").alias("batch_id"),
                                             F.lit(seen["captured_rows"]).cast("bigint").alias("captured_rows"),
                                             F.lit(seen["rows_without_key"]).cast("bigint").alias("rows_without_key"))
            row.write.mode("overwrite").parquet(f"{self.path}/batch={progress.batchId}")
        except Exception as ex:  # noqa: BLE001 - a listener's thread has no caller; raised by finish
            self.failure = ex

    def finish(self, timeout_s: float = 60) -> None:
        """Wait until the run's last event has come; raise what went wrong in writing."""
        if not self.ended.wait(timeout_s):
            raise TimeoutError("the run's end was not reported")
        if self.failure is not None:
            raise self.failure


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).parquet(f"{path}/batch=*")
