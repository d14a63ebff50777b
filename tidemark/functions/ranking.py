"""Global 1-based positions under a total order, without moving all rows to one task.

``row_number()`` over a window without a partition key gathers the whole input in a
single task.  ``with_position`` instead:

1. range-partitions the rows by the order (sampled bounds, balanced partitions), stores
   each row's partition id as a column and writes the result once to a table in the
   shared checkpoint folder — the id is then data, so both uses below see the same
   assignment even if an executor is lost and tasks are recomputed;
2. numbers rows inside each partition (window partitioned by the partition id);
3. counts rows per partition (one row per partition) and turns the counts into start
   offsets; that table is bounded by the partition count, so broadcasting it is safe;
4. position = partition offset + position inside the partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def with_position(df: DataFrame, order: list[Column], name: str = "pos", partitions: int | None = None) -> DataFrame:
    """``df`` plus a bigint column ``name`` = 1-based position under ``order``.

    ``order`` must be a total order (add a unique tie-breaker), otherwise positions of
    tied rows are arbitrary, as with ``row_number``.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranked")
    staged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    staged.write.parquet(path)
    tagged = spark.read.schema(staged.schema).parquet(path)
    local = tagged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the running total over it is a bounded, tiny computation.
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_offset"))
    return (local.join(F.broadcast(offsets), "_pid")
                 .withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint"))
                 .drop("_pid", "_local", "_offset"))
