"""Positions in a partitioned message log: dense offsets, start positions, lost and repeated messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import with_position

BLOCK = 1_000_000
SLOT = ["topic", "partition"]


class DataLoss(RuntimeError):
    pass


def partition_of(key: Column | str, partitions: int) -> Column:
    """Partition of a key: the first 32 bits of its MD5, modulo the number of partitions (a null
    key goes to partition 0).  Equal keys meet, so one partition's order is every key's order."""
    h = F.conv(F.substring(F.md5(F.col(key) if isinstance(key, str) else key), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(h, F.lit(partitions)), F.lit(0)).cast("int")


def with_offsets(messages: DataFrame, key: str, order: list[Column], partitions: int) -> DataFrame:
    """``messages`` with their ``partition`` and dense ``offset`` (from 0, in ``order``, a total one).

    Offsets come from range partitioning and per-task counts, so a hot key or partition is
    numbered by many tasks; only the first position of each partition is sent around."""
    slotted = messages.withColumn("partition", partition_of(key, partitions))
    numbered = with_position(slotted, [F.col("partition").asc(), *order], "_pos")
    first = numbered.groupBy("partition").agg(F.min("_pos").alias("_first"))          # one row a partition
    return numbered.join(F.broadcast(first), "partition").withColumn("offset", F.col("_pos") - F.col("_first")).drop("_pos", "_first")


def write_partitioned(messages: DataFrame, path: str, block: int = BLOCK) -> None:
    """Write numbered messages as a partitioned log: files of at most ``block`` offsets of one
    partition, each in offset order."""
    dealt = messages.withColumn("block", F.floor(F.col("offset") / block)).repartition("topic", "partition", "block")
    dealt.sortWithinPartitions("topic", "partition", "offset").write.partitionBy("topic", "partition", "block").parquet(path)


def from_positions(messages: DataFrame, start: DataFrame | str = "earliest") -> DataFrame:
    """Messages from a start position on: ``earliest``, or a table (topic, partition, start_offset);
    partitions that it doesn't name are read from their beginning."""
    if isinstance(start, str):
        if start != "earliest":
            raise ValueError("a start position is 'earliest' or a table of offsets")
        return messages
    first = start.select(*SLOT, "start_offset")
    return messages.join(first, SLOT, "left").where(F.col("start_offset").isNull() | (F.col("offset") >= F.col("start_offset"))).drop("start_offset")


def deliver_once(messages: DataFrame) -> DataFrame:
    """One message per (topic, partition, offset): repeated deliveries are the same message."""
    return messages.dropDuplicates([*SLOT, "offset"])


def spans(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Runs of consecutive offsets: topic, partition, first_offset, last_offset, deliveries.

    Islands are found inside blocks of offsets first (so a partition is worked on by many tasks) and
    joined across block borders after that, when only the islands are left."""
    each = messages.groupBy(*SLOT, "offset").agg(F.count(F.lit(1)).alias("deliveries"))
    blocked = each.withColumn("_block", F.floor(F.col("offset") / block))
    inside = Window.partitionBy(*SLOT, "_block").orderBy("offset")
    islands = (blocked.withColumn("_run", F.col("offset") - F.row_number().over(inside)).groupBy(*SLOT, "_block", "_run")
               .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.sum("deliveries").alias("deliveries")))
    across = Window.partitionBy(*SLOT).orderBy("first_offset")
    opens = F.coalesce(F.lag("last_offset").over(across) + 1 != F.col("first_offset"), F.lit(True))
    runs = islands.withColumn("_opens", opens.cast("int")).withColumn("_span", F.sum("_opens").over(across))
    return (runs.groupBy(*SLOT, "_span").agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"), F.sum("deliveries").alias("deliveries")).drop("_span"))


def offset_report(messages: DataFrame, start: DataFrame | str = "earliest", block: int = BLOCK) -> DataFrame:
    """``spans`` from a start position on, with ``lost`` (offsets missing right before the run: since the
    run before it, or since the start position) and ``repeated`` (deliveries beyond the first)."""
    found = spans(from_positions(messages, start), block)
    before = F.lag("last_offset").over(Window.partitionBy(*SLOT).orderBy("first_offset")) + 1
    if isinstance(start, str):
        first = F.coalesce(before, F.col("first_offset"))      # the log may begin anywhere
    else:
        found = found.join(start.select(*SLOT, "start_offset"), SLOT, "left")
        first = F.coalesce(before, F.col("start_offset"), F.col("first_offset"))
    return found.select(*SLOT, "first_offset", "last_offset", (F.col("first_offset") - first).alias("lost"),
                        (F.col("deliveries") - (F.col("last_offset") - F.col("first_offset") + 1)).alias("repeated"))


def require_no_loss(report: DataFrame) -> None:
    """The policy that fails on lost data."""
    row = report.where("lost > 0").orderBy(*SLOT, "first_offset").first()
    if row is not None:
        raise DataLoss(f"{row.lost} messages before offset {row.first_offset} of {row.topic}/{row.partition} are missing")
